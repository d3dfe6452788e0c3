"""Fixed values.

Everything in this module must keep exactly these values for results to agree
with the behaviour this library re-creates. They are stated once, here, in
natural order; the rest of the package refers to them by name.
"""

# ---- fixed values: accession mentions --------------------------------------
ACCESSION_PREFIX = "syn"          # ids are the prefix followed by digits
ACCESSION_MIN_DIGITS = 7
ACCESSION_MAX_DIGITS = 12
CONTEXT_WINDOW = 25               # characters kept on each side of a mention
ARTICLE_CURIE_PREFIX = "pmc:"     # stored article ids look like pmc:PMC123
ARTICLE_ID_PREFIX = "PMC"
ARTICLE_ID_TYPES = ("pmc", "pmcid")  # accepted pub-id-type attribute values
ARTICLE_OPEN = "<article "        # an article starts here (note the blank)
ARTICLE_CLOSE = "</article>"
CORPUS_FILE_RANGE = r"PMC(\d+)_PMC(\d+)"  # corpus file names carry an id range
LISTING_HREF = r'<a href="([^"]+)"'
CORPUS_SUFFIX = ".xml.gz"

# ---- fixed values: feeds ---------------------------------------------------
LINK_RECORD_SOURCE = "PMC"        # <record><source> of a link
SEARCH_XREF_DBNAME = "PMC"        # <ref dbname=...> of a search entry
SEARCH_DATE_TYPE = "submission"   # <date type=...>
SEARCH_FIELD_REPOSITORY = "repository"
SEARCH_FIELD_LINK = "full_dataset_link"
RESOURCE_DB = "pubmed"            # DB column of the resource list
RESOURCE_SUBJECT_TYPE = ""
RESOURCE_ATTRIBUTE = "registration required"

# ---- fixed values: input validation ----------------------------------------
MAX_INPUT_BYTES = 500 * 1024 * 1024
ALLOWED_EXTENSIONS = (".pdf", ".txt", ".xml", ".html", ".gz")
# leading bytes (hex) of accepted binary types: gzip, pdf; XML/HTML start with '<'
MAGIC_GZIP = "1F8B"
MAGIC_PDF = "25504446"
MAGIC_MARKUP = "3C"

# Whitespace as Python's str.isspace() sees it: Java's (?U)\s plus the four
# information separators U+001C..U+001F.
WS_CLASS = r"[\s\x{1C}-\x{1F}]"
