"""DuckDB SQL for every registered query that SQL can express.

The views are rebuilt in SQL from the same parquet tables. DuckDB's regex has no
look-around, so mining takes maximal runs ``[0-9]*syn[0-9]+`` and keeps the ones
that start with the prefix and have 7-12 digits; offsets come from summing the
lengths of the split pieces. Valid while no two ids touch without a gap.
"""

from __future__ import annotations

FINDINGS_V = """findings_v AS (
  SELECT 'pmc:PMC' || CAST(l_orderkey AS VARCHAR) AS pmcid,
         'syn' || CAST(1000000 + l_partkey AS VARCHAR) AS synid,
         'data at syn' || CAST(1000000 + l_partkey AS VARCHAR) || ' row ' || CAST(l_linenumber AS VARCHAR) AS context,
         'PMC' || CAST(l_orderkey - l_orderkey % 1000 AS VARCHAR) || '_PMC'
               || CAST(l_orderkey - l_orderkey % 1000 + 999 AS VARCHAR) || '.xml.gz' AS source_file
  FROM lineitem)"""

BATCHES_V = """batches_v AS (
  SELECT * FROM findings_v UNION ALL
  SELECT pmcid, synid, context, 'PMC0_PMC0.xml.gz' AS source_file FROM findings_v
  WHERE CAST(substring(pmcid, 8) AS BIGINT) % 5 = 0)"""

RESULTS_V = """results_v AS (
  SELECT DISTINCT pmcid, synid FROM findings_v WHERE CAST(substring(pmcid, 8) AS BIGINT) % 3 = 0)"""

ENTITY_V = """entity_v AS (
  SELECT 'syn' || CAST(1000000 + p_partkey AS VARCHAR) AS id, p_name AS name,
         900000 + p_partkey % 50 AS benefactor_id,
         '2024-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') || 'T00:00:00.000Z' AS created_on
  FROM part WHERE p_partkey % 10 <> 7)"""

GAPS_V = """gaps_v AS (
  SELECT CASE WHEN n % 50 = 1 THEN NULL WHEN n % 50 = 2 THEN '' ELSE pmcid END AS pmcid,
         CASE WHEN n % 50 = 3 THEN '' WHEN n % 50 = 4 THEN NULL ELSE synid END AS synid, context, source_file
  FROM (SELECT *, CAST(substring(pmcid, 8) AS BIGINT) AS n FROM findings_v))"""

CATALOG_V = """catalog_v AS (
  SELECT 'syn' || CAST(900000 + s_suppkey AS VARCHAR) AS id, 'app' || CAST(s_nationkey AS VARCHAR) AS app_id,
         CASE WHEN s_suppkey % 4 = 0 THEN NULL
              ELSE 'https://portal.example.org/' || CAST(s_suppkey AS VARCHAR) END AS link, s_suppkey AS ord
  FROM supplier WHERE s_suppkey % 5 <> 0
  UNION ALL
  SELECT 'syn' || CAST(900000 + s_suppkey AS VARCHAR), 'app' || CAST(s_nationkey + 1 AS VARCHAR), NULL, s_suppkey + 1000000000
  FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 = 3
  UNION ALL
  SELECT 'syn' || CAST(1000000 + p_partkey AS VARCHAR), 'app99', NULL, p_partkey + 2000000000 FROM part WHERE p_partkey % 100 = 3),
catalog_last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS back FROM catalog_v) WHERE back = 1)"""

APP_V = """app_v AS (
  SELECT DISTINCT 'app' || CAST(s_nationkey AS VARCHAR) AS app_id, 'Portal ' || CAST(s_nationkey AS VARCHAR) AS friendly_name, 1 AS ord
  FROM supplier WHERE s_nationkey % 5 <> 0
  UNION ALL
  SELECT DISTINCT 'app' || CAST(s_nationkey AS VARCHAR), 'Zz portal ' || CAST(s_nationkey AS VARCHAR), 0
  FROM supplier WHERE s_nationkey % 5 <> 0 AND s_nationkey % 3 = 1)"""


def text_v(upper_second: bool = False, repeat_first: bool = False) -> str:
    second = "' and SYN'" if upper_second else "' and syn'"
    tail = " || ' Again syn' || CAST(1000000 + doc_id AS VARCHAR) || '.'" if repeat_first else ""
    return f"""text_v AS (
  SELECT doc_id, lang, substring(text, 1, 40) || ' syn' || CAST(1000000 + doc_id AS VARCHAR)
         || {second} || CAST(2000000 + doc_id % 7 AS VARCHAR) || ', ' || substring(text, 41){tail} AS text
  FROM documents)"""


def mined(src: str, keys: str = "doc_id", window: int = 25) -> str:
    """CTEs m_d .. m_c over ``src(keys..., text)``; m_c has keys, pos, mention, synid, before_raw, after_raw."""
    return f"""m_d AS (SELECT {keys}, regexp_replace(text, '\\s+', ' ', 'g') AS text FROM {src}),
m_e AS (SELECT {keys}, text, regexp_extract_all(text, '(?i)[0-9]*syn[0-9]+') AS ids,
               string_split_regex(text, '(?i)[0-9]*syn[0-9]+') AS p FROM m_d),
m_u AS (SELECT {keys}, text, i, ids[i] AS m,
               CAST(list_sum(list_transform(p[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ids[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s
        FROM (SELECT *, unnest(generate_series(1, len(ids))) AS i FROM m_e)),
m_v AS (SELECT * FROM m_u WHERE lower(m) LIKE 'syn%' AND length(m) BETWEEN 10 AND 15),
m_c AS (SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY i) - 1 AS INTEGER) AS pos,
               m AS mention, lower(m) AS synid,
               substring(text, greatest(0, s - {window}) + 1, s - greatest(0, s - {window})) AS before_raw,
               substring(text, s + length(m) + 1, least(length(text), s + length(m) + {window}) - (s + length(m))) AS after_raw
        FROM m_v),
m_f AS (SELECT {keys}, pos, synid, replace(trim(before_raw || mention || after_raw), '"', '''') AS context
        FROM m_c WHERE contains(trim(before_raw || mention || after_raw), synid))"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


DOC_FINDINGS = w(text_v(), mined("text_v")) + ", f AS (SELECT doc_id, 'pmc:PMC' || CAST(doc_id AS VARCHAR) AS pmcid, pos, synid, context FROM m_f)\n"
DOC_FINDINGS_REPEAT = (w(text_v(repeat_first=True), mined("text_v"))
                       + ", f AS (SELECT doc_id, 'pmc:PMC' || CAST(doc_id AS VARCHAR) AS pmcid, pos, synid, context FROM m_f)\n")

XML_TEXT = """x_v AS (SELECT doc_id, lang,
    'PMC' || CAST(doc_id - doc_id % 100 AS VARCHAR) || '_PMC' || CAST(doc_id - doc_id % 100 + 99 AS VARCHAR) || '.xml.gz' AS source_file,
    'Document ' || CAST(doc_id AS VARCHAR) || ' ' || text AS text FROM text_v)"""

XML_DOC = """xml_v AS (SELECT doc_id, lang,
    'PMC' || CAST(doc_id - doc_id % 100 AS VARCHAR) || '_PMC' || CAST(doc_id - doc_id % 100 + 99 AS VARCHAR) || '.xml.gz' AS source_file,
    '<article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="research-article"><front><article-meta>'
    || CASE WHEN lang = 'fr' THEN '<article-id pub-id-type="pmcid">' || CAST(doc_id AS VARCHAR) || '</article-id>'
            WHEN lang = 'es' THEN '<self-uri>PMC' || CAST(doc_id AS VARCHAR) || '</self-uri>'
            ELSE '<article-id pub-id-type="pmc">PMC' || CAST(doc_id AS VARCHAR) || '</article-id>' END
    || '<title-group><article-title>Document ' || CAST(doc_id AS VARCHAR)
    || '</article-title></title-group></article-meta></front><body><p>'
    || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || CASE WHEN lang = 'de' THEN '</body></p>' ELSE '</p></body>' END || '</article>' AS xml
  FROM text_v)"""

CORPUS_NAMES = """names AS (
  SELECT DISTINCT file_name FROM (
    SELECT source_file AS file_name FROM batches_v
    UNION ALL SELECT unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) AS file_name FROM pages)),
catalog AS (
  SELECT file_name, CAST(regexp_extract(file_name, 'PMC([0-9]+)_PMC([0-9]+)', 1) AS BIGINT) AS start_pmc,
         CAST(regexp_extract(file_name, 'PMC([0-9]+)_PMC([0-9]+)', 2) AS BIGINT) AS end_pmc,
         'PMC' || regexp_extract(file_name, 'PMC([0-9]+)_PMC([0-9]+)', 1) AS start_id
  FROM names WHERE regexp_matches(file_name, 'PMC([0-9]+)_PMC([0-9]+)'))"""


APPS1 = "apps1 AS (SELECT app_id, arg_max(friendly_name, ord) AS friendly_name FROM app_v GROUP BY app_id)"


def cache_ctes() -> str:
    """Entity metadata (portal resolved), the old cache and the refreshed cache."""
    return APPS1 + """,
cat AS (SELECT c.id, coalesce(c.app_id, '') AS app_id, nullif(c.link, '') AS link,
               coalesce(a.friendly_name, 'Repository') AS repository
        FROM catalog_last c LEFT JOIN apps1 a ON coalesce(c.app_id, '') = a.app_id),
ent AS (SELECT id, coalesce(nullif(name, ''), id) AS name, coalesce(substring(created_on, 1, 10), '') AS created_on,
               CASE WHEN benefactor_id IS NOT NULL AND benefactor_id <> 0
                    THEN 'syn' || CAST(benefactor_id AS VARCHAR) END AS parent_id
        FROM entity_v),
meta AS (SELECT e.id, e.name, e.name AS description, e.created_on,
                CASE WHEN o.id IS NOT NULL THEN o.repository WHEN p.id IS NOT NULL THEN p.repository
                     ELSE 'Repository' END AS repository,
                CASE WHEN o.id IS NOT NULL THEN o.link WHEN p.id IS NOT NULL THEN p.link END AS portal_link
         FROM ent e LEFT JOIN cat o ON e.id = o.id LEFT JOIN cat p ON e.parent_id = p.id),
old_cache AS (SELECT id, 'cached ' || name AS name, 'cached ' || name AS description, created_on, repository, portal_link
              FROM meta WHERE id IN (SELECT id FROM entity_v WHERE created_on < '2024-01-15')),
want AS (SELECT DISTINCT synid AS id FROM findings_v
         WHERE synid IS NOT NULL AND synid <> '' AND regexp_replace(pmcid, '^pmc:', '') <> ''),
new_cache AS (SELECT * FROM old_cache UNION ALL
              SELECT * FROM meta WHERE id IN (SELECT id FROM want) AND id NOT IN (SELECT id FROM old_cache))"""


def pairs(src: str = "findings_v") -> str:
    return f"""pairs AS (SELECT DISTINCT synid, regexp_replace(pmcid, '^pmc:', '') AS pmcid FROM {src}
          WHERE synid IS NOT NULL AND synid <> '' AND regexp_replace(pmcid, '^pmc:', '') <> '')"""


PAIRS = pairs()

SQL: dict[str, str] = {
    "mention_context": DOC_FINDINGS + "SELECT doc_id, pmcid, synid, context FROM f",
    "mentions": w(text_v(), mined("text_v")) + "SELECT doc_id, pos, mention, synid FROM m_c",
    "clean_text": "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, "
                  "length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS n_chars FROM documents",
    "kwic": w(text_v(), mined("text_v")) + """SELECT doc_id, pos, synid, trim(before_raw) AS before, trim(after_raw) AS after,
        trim(concat_ws(' ', trim(before_raw), mention, trim(after_raw))) AS "full" FROM m_c""",
    "case_filter": w(text_v(upper_second=True), mined("text_v")) + """SELECT doc_id, pos, synid, context, 'reference' AS rule FROM m_f
        UNION ALL SELECT doc_id, pos, synid, replace(trim(before_raw || mention || after_raw), '"', '''') AS context, 'fold' AS rule
        FROM m_c WHERE regexp_full_match(synid, 'syn[0-9]{7,12}')""",
    "dedup_in_doc": DOC_FINDINGS_REPEAT + """SELECT pmcid, synid, min(pos) AS pos,
        arg_min(context, pos) AS context FROM f GROUP BY pmcid, synid""",
    "summary": DOC_FINDINGS + """SELECT count(DISTINCT pmcid) AS documents, count(*) AS mentions,
        count(DISTINCT synid) AS unique_ids FROM f""",
    "top_ids": DOC_FINDINGS + """SELECT synid, count(*) AS mentions FROM f GROUP BY synid
        ORDER BY mentions DESC, synid LIMIT 10""",
    "doc_counts": DOC_FINDINGS_REPEAT + """SELECT pmcid, count(*) AS mentions, count(DISTINCT synid) AS unique_ids
        FROM f GROUP BY pmcid""",
    "curie_strip": w(FINDINGS_V) + """SELECT pmcid, regexp_replace(pmcid, '^pmc:', '') AS article_id,
        'pmc:' || regexp_replace(pmcid, '^pmc:', '') AS curie FROM findings_v""",
    "xml_mine": w(text_v(), XML_TEXT, "src AS (SELECT * FROM x_v WHERE lang <> 'de')",
                  mined("src", "doc_id, source_file")) + """SELECT source_file,
        'pmc:PMC' || CAST(doc_id AS VARCHAR) AS pmcid, synid, context FROM m_f""",
    "article_id": """SELECT doc_id, lang <> 'de' AS ok,
        CASE WHEN lang <> 'de' THEN 'PMC' || CAST(doc_id AS VARCHAR) END AS pmc_id FROM documents""",
    "reject_audit": """SELECT doc_id, lang,
        'PMC' || CAST(doc_id - doc_id % 100 AS VARCHAR) || '_PMC' || CAST(doc_id - doc_id % 100 + 99 AS VARCHAR) || '.xml.gz' AS source_file
        FROM documents WHERE lang = 'de'""",
    "coverage_audit": w(text_v(), XML_TEXT, "src AS (SELECT * FROM x_v WHERE lang <> 'de')",
                        mined("src", "doc_id, source_file")) + """, per_doc AS (
          SELECT source_file, doc_id, count(*) AS n FROM m_f GROUP BY source_file, doc_id),
        per_file AS (SELECT source_file, count(*) AS articles_with_findings, sum(n) AS findings
          FROM per_doc GROUP BY source_file),
        seen AS (SELECT source_file, count(*) AS articles, count(*) FILTER (WHERE lang <> 'de') AS parsed,
          count(*) FILTER (WHERE lang <> 'de') AS with_id FROM x_v GROUP BY source_file)
        SELECT s.source_file, s.articles, s.parsed, s.with_id,
               coalesce(p.articles_with_findings, 0) AS articles_with_findings,
               CAST(coalesce(p.findings, 0) AS BIGINT) AS findings
        FROM seen s LEFT JOIN per_file p USING (source_file)""",
    "text_decode": """SELECT doc_id,
        CASE WHEN lang IN ('fr', 'de', 'es') AND regexp_matches(text, '[^\\x00-\\x7F]')
                  AND NOT regexp_matches(text, '[^\\x00-\\xFF]') THEN 'latin-1' ELSE 'utf-8' END AS decoded_with,
        true AS same, length(text) AS n_chars FROM documents""",
    "file_catalog": w(FINDINGS_V, BATCHES_V, CORPUS_NAMES) + "SELECT file_name, start_pmc, end_pmc, start_id FROM catalog",
    "listed_files": """SELECT DISTINCT 'PMC' || CAST(b AS VARCHAR) || '_PMC' || CAST(b + 99 AS VARCHAR) || '.xml.gz' AS file_name,
        b AS start_pmc, b + 99 AS end_pmc, 'PMC' || CAST(b AS VARCHAR) AS start_id
        FROM (SELECT doc_id - doc_id % 100 AS b FROM documents)""",
    "page_links": """SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href
        FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS h FROM pages)""",
    "resume_files": w(FINDINGS_V, BATCHES_V, CORPUS_NAMES) + """SELECT file_name, start_pmc, end_pmc FROM catalog
        WHERE start_pmc >= 5000 ORDER BY start_pmc, file_name LIMIT 5""",
    "watermark": w(FINDINGS_V) + """SELECT 'PMC' || CAST(max(CAST(regexp_extract(source_file, 'PMC([0-9]+)_PMC([0-9]+)', 1) AS BIGINT)) AS VARCHAR)
        AS last_processed_pmc_id, max(CAST(regexp_extract(source_file, 'PMC([0-9]+)_PMC([0-9]+)', 1) AS BIGINT)) AS start_pmc
        FROM findings_v""",
    "new_rows": w(FINDINGS_V, RESULTS_V) + """SELECT * FROM findings_v
        WHERE pmcid NOT IN (SELECT pmcid FROM results_v)""",
    "first_batch_wins": w(FINDINGS_V, BATCHES_V, RESULTS_V) + """SELECT pmcid, synid, context, source_file FROM (
        SELECT *, min(source_file) OVER (PARTITION BY pmcid) AS first_file FROM batches_v)
        WHERE source_file = first_file AND pmcid NOT IN (SELECT pmcid FROM results_v)""",
    "combine_dedup": w(FINDINGS_V, BATCHES_V) + """SELECT pmcid, synid, context, min(source_file) AS source_file
        FROM batches_v GROUP BY pmcid, synid, context""",
    "combine_stats": w(FINDINGS_V, BATCHES_V) + """SELECT count(*) AS rows_before,
        (SELECT count(*) FROM (SELECT DISTINCT pmcid, synid, context FROM batches_v)) AS rows_after,
        count(DISTINCT synid) AS unique_synids, count(DISTINCT source_file) AS files FROM batches_v""",
    "union_batches": w(FINDINGS_V, RESULTS_V) + """SELECT pmcid, synid, context, source_file FROM findings_v
        UNION ALL SELECT pmcid, synid, NULL, NULL FROM results_v""",
    "distinct_links": w(FINDINGS_V, GAPS_V) + """SELECT DISTINCT regexp_replace(pmcid, '^pmc:', '') AS pmcid, synid
        FROM gaps_v WHERE pmcid IS NOT NULL AND pmcid <> '' AND synid IS NOT NULL AND synid <> ''""",
    "citations_by_id": w(FINDINGS_V, GAPS_V, pairs("gaps_v")) + """SELECT p.synid, p.pmcid, c.n_articles FROM pairs p
        JOIN (SELECT synid, count(*) AS n_articles FROM pairs GROUP BY synid) c USING (synid)""",
    "catalog_names": w(CATALOG_V, APP_V, APPS1) + """SELECT c.id, coalesce(c.app_id, '') AS app_id,
        nullif(c.link, '') AS link, coalesce(a.friendly_name, 'Repository') AS repository
        FROM catalog_last c LEFT JOIN apps1 a ON coalesce(c.app_id, '') = a.app_id""",
    "portal_resolve": w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes()) + """SELECT e.id, e.parent_id,
        m.repository, m.portal_link FROM ent e JOIN meta m USING (id)""",
    "cache_miss": w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes()) + "SELECT * FROM new_cache",
    "cache_refresh": w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes())
                     + "SELECT * FROM meta WHERE id IN (SELECT id FROM want)",
    "search_entries": w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes(), PAIRS) + """SELECT c.synid AS id,
        coalesce(nullif(n.name, ''), c.synid) AS name,
        coalesce(nullif(n.description, ''), coalesce(nullif(n.name, ''), c.synid)) AS description,
        nullif(n.created_on, '') AS created,
        coalesce(nullif(n.repository, ''), 'Repository') AS repository,
        coalesce(nullif(n.portal_link, ''), 'https://repository.example.org/' || c.synid) AS full_link, c.n_refs
        FROM (SELECT synid, count(*) AS n_refs FROM pairs GROUP BY synid) c JOIN new_cache n ON n.id = c.synid""",
    "inaccessible": w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes()) + """SELECT id AS synid FROM want
        WHERE id NOT IN (SELECT id FROM new_cache)""",
    "resource_list": w(FINDINGS_V, GAPS_V) + """SELECT CAST(1000 AS BIGINT) AS PrId, 'pubmed' AS DB, nullif(pmcid, '') AS UID,
        'https://repository.example.org/#!' || synid AS URL, '' AS SubjectType,
        'registration required' AS Attribute FROM gaps_v WHERE pmcid IS NOT NULL""",
}


def _xt(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _xa(x: str) -> str:
    e = _xt(x)
    for a, b in (("'\"'", "'&quot;'"), ("chr(10)", "'&#10;'"), ("chr(13)", "'&#13;'"), ("chr(9)", "'&#09;'")):
        e = f"replace({e}, {a}, {b})"
    return e


SEARCH_ENTRIES_CTE = """e AS (SELECT c.synid AS id,
        coalesce(nullif(n.name, ''), c.synid) AS name,
        coalesce(nullif(n.description, ''), coalesce(nullif(n.name, ''), c.synid)) AS description,
        nullif(n.created_on, '') AS created,
        coalesce(nullif(n.repository, ''), 'Repository') AS repository,
        coalesce(nullif(n.portal_link, ''), 'https://repository.example.org/' || c.synid) AS full_link, c.n_refs
        FROM (SELECT synid, count(*) AS n_refs FROM pairs GROUP BY synid) c JOIN new_cache n ON n.id = c.synid)"""

_I6, _I8 = " " * 6, " " * 8


def _whole(k1: int, text: str, k0: str = "''") -> str:
    return f"SELECT {k0} AS k0, {k1} AS k1, '' AS k2, {text} AS line"


def _entry(k1: int, text: str, rows: str = "e") -> str:
    return f"SELECT id AS k0, {k1} AS k1, '' AS k2, {text} AS line FROM {rows}"


_DATED = "e WHERE created IS NOT NULL"
FEED_LINES = "lines AS (" + " UNION ALL ".join([
    _whole(0, "'<?xml version=''1.0'' encoding=''UTF-8''?>'"), _whole(1, "'<database>'"), _whole(2, "'  <name>Datasets</name>'"),
    _whole(3, "'  <description>Datasets cited in articles</description>'"), _whole(4, "'  <release>2026-01-01</release>'"),
    _whole(5, "'  <release_date>2026-01-01</release_date>'"),
    _whole(6, "'  <entry_count>' || CAST(count(*) AS VARCHAR) || '</entry_count>'") + " FROM e", _whole(7, "'  <entries>'"),
    _entry(0, f"'    <entry id=\"' || {_xa('id')} || '\">'"),
    _entry(1, f"'{_I6}<name>' || {_xt('name')} || '</name>'"),
    _entry(2, f"'{_I6}<description>' || {_xt('description')} || '</description>'"),
    _entry(3, f"'{_I6}<dates>'", _DATED),
    _entry(4, f"'{_I8}<date type=\"submission\" value=\"' || {_xa('created')} || '\" />'", _DATED),
    _entry(5, f"'{_I6}</dates>'", _DATED),
    _entry(6, f"'{_I6}<cross_references>'"),
    f"SELECT p.synid, 7, p.pmcid, '{_I8}<ref dbname=\"PMC\" dbkey=\"' || {_xa('p.pmcid')} || '\" />' FROM pairs p WHERE p.synid IN (SELECT id FROM e)",
    _entry(8, f"'{_I6}</cross_references>'"),
    _entry(9, f"'{_I6}<additional_fields>'"),
    _entry(10, f"'{_I8}<field name=\"repository\">' || {_xt('repository')} || '</field>'"),
    _entry(11, f"'{_I8}<field name=\"full_dataset_link\">' || {_xt('full_link')} || '</field>'"),
    _entry(12, f"'{_I6}</additional_fields>'"),
    _entry(13, "'    </entry>'"),
    _whole(0, "'  </entries>'", "'~'"), _whole(1, "'</database>'", "'~'"),      # after every id
]) + ")"
SEARCH_FEED_CTES = w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes(), PAIRS, SEARCH_ENTRIES_CTE, FEED_LINES)
SEARCH_FEED = SEARCH_FEED_CTES + "SELECT line FROM lines"

LINKS = """links AS (SELECT DISTINCT regexp_replace(pmcid, '^pmc:', '') AS pmcid, synid
        FROM findings_v WHERE pmcid IS NOT NULL AND pmcid <> '' AND synid IS NOT NULL AND synid <> '')"""

SQL.update({
    "article_scan": w(text_v(), XML_DOC) + "SELECT source_file, xml FROM xml_v",
    "findings_csv_roundtrip": w(FINDINGS_V) + "SELECT pmcid, synid, context, source_file FROM findings_v",
    "link_feed": w(FINDINGS_V, LINKS) + """SELECT CAST(1000 AS BIGINT) AS provider_id,
        'https://repository.example.org/' || synid AS url, 'View data' AS title, 'PMC' AS source,
        pmcid AS record_id FROM links""",
    "feed_validate": w(FINDINGS_V, LINKS) + """SELECT 'good' AS feed, true AS valid, count(*) AS links,
        count(*) AS with_record FROM links
        UNION ALL SELECT 'bad', false, count(*), 0 FROM links""",
    "input_audit": w(FINDINGS_V) + """SELECT 'corpus' AS kind, '.gz' AS ext, true AS accepted, 'ok' AS reason,
        count(DISTINCT doc_id - doc_id % 100) AS files FROM documents
        UNION ALL SELECT 'batches', '.csv', false, 'extension', count(DISTINCT source_file) FROM findings_v""",
    "search_feed": SEARCH_FEED,
    "search_feed_order": SEARCH_FEED_CTES + "SELECT row_number() OVER (ORDER BY k0, k1, k2) - 1 AS n, line FROM lines",
    "stream_ingest": SQL["xml_mine"],
    "stream_append": SQL["first_batch_wins"],
    "stream_rejects": w(text_v()) + """SELECT 'PMC' || CAST(b AS VARCHAR) || '_PMC' || CAST(b + 99 AS VARCHAR) || '.xml.gz' AS source_file,
        2 * count(*) FILTER (WHERE lang <> 'de') AS findings, count(*) FILTER (WHERE lang = 'de') AS rejects,
        count(*) FILTER (WHERE lang = 'de') AS with_reason
        FROM (SELECT doc_id - doc_id % 100 AS b, lang FROM text_v) GROUP BY b""",
    "incremental_run": SQL["xml_mine"].replace("SELECT source_file,\n        'pmc:PMC'", "SELECT 'pmc:PMC'"),
    "combine_job": SQL["combine_dedup"],
    "cache_swap": SQL["cache_miss"],
    "text_files": "SELECT doc_id, text, length(text) AS n_chars FROM documents",
    "kwic_offsets": r"""WITH t AS (SELECT doc_id, text, greatest(strpos(text, ' ') - 1, 0) AS at_char FROM documents),
        k AS (SELECT doc_id, trim(substring(text, greatest(0, at_char - 10) + 1, at_char - greatest(0, at_char - 10)), E' \n\t\r') AS before,
                     trim(substring(text, at_char + 2, greatest(0, least(length(text), at_char + 11) - at_char - 1)), E' \n\t\r') AS after,
                     substring(text, at_char + 1, 1) AS target FROM t)
        SELECT doc_id, before, after, trim(before || ' ' || target || ' ' || after, E' \n\t\r') AS "full" FROM k""",
    "entity_headers": w(ENTITY_V) + "SELECT id, name, benefactor_id, created_on FROM entity_v",
    "portal_landed": SQL["portal_resolve"],
    "citations_kept": SQL["citations_by_id"],
    "counts_kept": w(FINDINGS_V, BATCHES_V) + """SELECT count(*) AS rows_before,
        (SELECT count(*) FROM (SELECT DISTINCT pmcid, synid, context FROM batches_v)) AS rows_after,
        count(DISTINCT synid) AS unique_synids, count(DISTINCT source_file) AS files,
        count(DISTINCT pmcid) AS documents, count(*) AS mentions, count(DISTINCT synid) AS unique_ids FROM batches_v""",
    "feed_check": w(FINDINGS_V, ENTITY_V, CATALOG_V, APP_V, cache_ctes(), PAIRS) + """, n AS (SELECT count(*) AS n FROM want JOIN new_cache USING (id))
        SELECT feed, "check", NOT (n > 0 AND ((feed = 'open entry' AND "check" = 'document') OR (feed = 'miscounted' AND "check" = 'entry_count')
               OR (feed = 'missing shard' AND "check" = 'shards'))) AS ok
        FROM n, (SELECT unnest(['whole', 'open entry', 'miscounted', 'missing shard']) AS feed), (SELECT unnest(['shards', 'document', 'entry_count']) AS "check")
        WHERE feed <> 'missing shard' OR "check" = 'shards'""",
    "stream_coverage": SQL["coverage_audit"],
    "stream_keyed": SQL["first_batch_wins"],
    "stored_lookup": SQL["new_rows"],
    "incremental_slices": w(text_v(), XML_TEXT, """twice AS (
          SELECT doc_id, lang, source_file, text FROM x_v
          UNION ALL SELECT doc_id, lang, 'PMC' || CAST(b AS VARCHAR) || '_PMC' || CAST(b + 99 AS VARCHAR) || '.xml.gz' AS source_file,
            'Document ' || CAST(doc_id AS VARCHAR) || ' copied ' || substring(text, strpos(text, ' syn') + 1) AS text
          FROM (SELECT doc_id, lang, text, (doc_id - doc_id % 100) * 10 + 1000 AS b FROM text_v))""",
                            """src AS (SELECT doc_id, arg_min(text, source_file) AS text FROM twice WHERE lang <> 'de' GROUP BY doc_id)""",
                            mined("src", "doc_id")) + """SELECT 'pmc:PMC' || CAST(doc_id AS VARCHAR) AS pmcid, synid, context FROM m_f""",
})
