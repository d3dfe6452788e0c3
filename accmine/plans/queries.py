"""Registered queries: one per operator of the coverage list. Each takes
``(spark, sf_dir)``, reads the driver's tables (through the views of
``sources.fixtures``) and returns a DataFrame whose columns match the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import jobs, schemas
from ..functions.fixed import ARTICLE_CURIE_PREFIX, LISTING_HREF
from ..functions.text import clean_text, decode_text, decoded_with, kwic, kwic_pieces, strip_curie
from ..operators import dedup, enrich, incremental, summarize
from ..operators.articles import coverage, findings_from_articles, rejects
from ..operators.mine import extract_mentions, findings_from_mentions, mine_text, prepare_text
from ..operators.parse import parse_articles
from ..session import brief_shuffles, job_scratch, scratch_path
from ..sinks import feed_check, feeds
from ..sinks.citations import CitationStore
from ..sinks.feeds import resource_rows, write_csv
from ..sinks.results import ResultsTable
from ..sinks.tables import read_version, stage, write_version
from ..sinks.versions import Files, VersionedTable
from ..sources import fixtures as fx
from ..sources.corpus import audit_files, read_articles, read_findings_csv, read_text_files, write_corpus
from ..sources.headers import read_entity_headers
from ..sources.tables import read_entity_meta, read_results, table
from ..streaming.ingest import append_keyed, append_results, ingest_corpus, init_results_table, stream_coverage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CFG = enrich.PortalConfig()
PROVIDER_ID = 1000
RESUME_FROM = "PMC5000_PMC5999.xml.gz"
RESUME_MAX_FILES = 5
TOP_K = 10
FEED_SHARDS = 3
WINDOW_SMALL = 10
JOB_SLICE = 1000


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- mining ----

def doc_findings(spark, d, **kw) -> DataFrame:
    """Findings mined from the documents view: doc_id, pmcid, pos, synid, context."""
    f = mine_text(fx.article_text_v(spark, d, **kw), "text", ("doc_id",))
    return f.select("doc_id", F.concat(F.lit("pmc:PMC"), F.col("doc_id").cast("string")).alias("pmcid"),
                    "pos", "synid", "context")


@query("mention_context")
def q_mention_context(spark, d):
    return doc_findings(spark, d).select("doc_id", "pmcid", "synid", "context")


@query("mentions")
def q_mentions(spark, d):
    t = prepare_text(fx.article_text_v(spark, d))
    m = extract_mentions(t, "text", ("doc_id",), prefilter=False)
    return m.select("doc_id", "pos", "mention", F.lower("mention").alias("synid"))


@query("clean_text")
def q_clean_text(spark, d):
    t = table(spark, d, "documents").select("doc_id", clean_text("text").alias("text"))
    return t.select("doc_id", "text", F.length("text").cast("bigint").alias("n_chars"))


@query("kwic")
def q_kwic(spark, d):
    t = prepare_text(fx.article_text_v(spark, d))
    m = extract_mentions(t, "text", ("doc_id",), prefilter=False)
    k = kwic_pieces("before", "mention", "after")
    return m.select("doc_id", "pos", F.lower("mention").alias("synid"), k["before"].alias("before"),
                    k["after"].alias("after"), k["full"].alias("full"))


@query("case_filter")
def q_case_filter(spark, d):
    t = prepare_text(fx.article_text_v(spark, d, upper_second=True))
    m = extract_mentions(t, "text", ("doc_id",), prefilter=False)
    kept = [findings_from_mentions(m, ("doc_id",), rule).withColumn("rule", F.lit(rule)) for rule in ("reference", "fold")]
    return kept[0].unionByName(kept[1])


@query("dedup_in_doc")
def q_dedup_in_doc(spark, d):
    return dedup.first_per_document(doc_findings(spark, d, repeat_first=True).drop("doc_id"))


@query("summary")
def q_summary(spark, d):
    return summarize.summary(doc_findings(spark, d))


@query("top_ids")
def q_top_ids(spark, d):
    return summarize.top_ids(doc_findings(spark, d), TOP_K)


@query("doc_counts")
def q_doc_counts(spark, d):
    return summarize.doc_counts(doc_findings(spark, d, repeat_first=True))


@query("curie_strip")
def q_curie_strip(spark, d):
    f = fx.findings_v(spark, d)
    a = strip_curie("pmcid")
    return f.select("pmcid", a.alias("article_id"), F.concat(F.lit(ARTICLE_CURIE_PREFIX), a).alias("curie"))


# ------------------------------------------------------------ XML path ------

def parsed_articles(spark, d) -> DataFrame:
    raw = fx.articles_xml_v(spark, d)
    return parse_articles(raw, "xml", ("doc_id", "lang", "source_file"))


@query("xml_mine")
def q_xml_mine(spark, d):
    f = findings_from_articles(parsed_articles(spark, d), ("source_file",))
    return f.select("source_file", "pmcid", "synid", "context")


@query("article_id")
def q_article_id(spark, d):
    return parsed_articles(spark, d).select("doc_id", "ok", "pmc_id")


@query("reject_audit")
def q_reject_audit(spark, d):
    return rejects(parsed_articles(spark, d), ("doc_id", "lang", "source_file")).drop("reason")


@query("coverage_audit")
def q_coverage_audit(spark, d):
    return coverage(parsed_articles(spark, d).select("source_file", "ok", "pmc_id", "text"))


@query("text_decode")
def q_text_decode(spark, d):
    doc = table(spark, d, "documents").select("doc_id", "lang", "text")
    latin = F.col("lang").isin("fr", "de", "es") & F.col("text").rlike(r"^[\x{00}-\x{FF}]*$")
    raw = F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    b = doc.select("doc_id", "text", raw.alias("content"))
    out = b.select("doc_id", "text", decode_text("content").alias("decoded"),
                   decoded_with("content").alias("decoded_with"))
    return out.select("doc_id", "decoded_with", (F.col("decoded") == F.col("text")).alias("same"),
                      F.length("decoded").cast("bigint").alias("n_chars"))


@query("text_files")
def q_text_files(spark, d):
    """The documents as JSON files, some in Latin-1, read as plain text of either encoding."""
    doc = table(spark, d, "documents").select("doc_id", "lang", "text")
    latin = F.col("lang").isin("fr", "de", "es") & F.col("text").rlike(r"^[\x{00}-\x{FF}]*$")
    root = scratch_path(spark, "text-files")
    for name, rows, encoding in (("latin", doc.where(latin), "ISO-8859-1"), ("other", doc.where(~latin), "UTF-8")):
        rows.select("doc_id", "text").write.option("encoding", encoding).json(f"{root}/{name}")
    lines = read_text_files(spark, f"{root}/*", "*.json").select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return lines.select(F.from_json("line", "doc_id bigint, text string").alias("r")).select(
        "r.doc_id", "r.text", F.length("r.text").cast("bigint").alias("n_chars"))


@query("kwic_offsets")
def q_kwic_offsets(spark, d):
    """Keyword in context by offsets: around the first blank of every document."""
    t = table(spark, d, "documents").select("doc_id", "text", (F.instr("text", " ") - 1).alias("at"))
    k = kwic("text", F.greatest(F.col("at"), F.lit(0)), F.greatest(F.col("at"), F.lit(0)) + 1, WINDOW_SMALL)
    return t.select("doc_id", k["before"].alias("before"), k["after"].alias("after"), k["full"].alias("full"))


# --------------------------------------------------------- file names -------

def corpus_names(spark, d) -> DataFrame:
    files = fx.batches_v(spark, d).select(F.col("source_file").alias("file_name"))
    hrefs = table(spark, d, "pages").select(
        F.explode(F.regexp_extract_all("html", F.lit(LISTING_HREF), F.lit(1))).alias("file_name"))
    return files.unionByName(hrefs).distinct()


@query("listed_files")
def q_listed_files(spark, d):
    return incremental.file_catalog(incremental.listed_files(fx.listing_v(spark, d)))


@query("file_catalog")
def q_file_catalog(spark, d):
    return incremental.file_catalog(corpus_names(spark, d))


@query("page_links")
def q_page_links(spark, d):
    p = table(spark, d, "pages").select("page_id", "html")
    return p.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(LISTING_HREF), F.lit(1)))
                    .alias("pos", "href"))


@query("resume_files")
def q_resume_files(spark, d):
    files = incremental.file_catalog(corpus_names(spark, d))
    return incremental.resume_files(files, RESUME_FROM, RESUME_MAX_FILES).select(
        "file_name", "start_pmc", "end_pmc")


@query("watermark")
def q_watermark(spark, d):
    done = fx.findings_v(spark, d).select(F.col("source_file").alias("file_name")).distinct()
    return incremental.watermark(done)


# ------------------------------------------------------ results table -------

def stored_results(spark, d) -> DataFrame:
    """The results table as an earlier run left it, read the way the jobs read it."""
    path = scratch_path(spark, "results")
    fx.results_v(spark, d).withColumn("context", F.lit(None).cast("string")).write.parquet(path)
    return read_results(spark, path)


@query("new_rows")
def q_new_rows(spark, d):
    return incremental.new_rows(fx.findings_v(spark, d), stored_results(spark, d))


@query("stored_lookup")
def q_stored_lookup(spark, d):
    """``new_rows`` by the index: the results table grown in three appends, the batch's articles looked up."""
    results = ResultsTable(spark, scratch_path(spark, "indexed-results"))
    stored = fx.results_v(spark, d)
    third = F.pmod(F.xxhash64("pmcid"), F.lit(3))
    for k in range(3):
        results.append(lambda lookup: incremental.new_rows(stored.where(third == k), lookup))  # noqa: B023
    return incremental.new_rows(fx.findings_v(spark, d), results.lookup(results.base()))


@query("first_batch_wins")
def q_first_batch_wins(spark, d):
    return incremental.first_batch_wins(fx.batches_v(spark, d), stored_results(spark, d))


@query("combine_dedup")
def q_combine_dedup(spark, d):
    return dedup.combine_dedup(fx.batches_v(spark, d))


@query("combine_stats")
def q_combine_stats(spark, d):
    return dedup.combine_stats(fx.batches_v(spark, d))


@query("union_batches")
def q_union_batches(spark, d):
    return dedup.union_batches([fx.findings_v(spark, d), fx.results_v(spark, d)])


@query("distinct_links")
def q_distinct_links(spark, d):
    return dedup.distinct_links(fx.gaps_v(spark, d))


@query("citations_by_id")
def q_citations_by_id(spark, d):
    return summarize.citations_by_id(fx.gaps_v(spark, d))


def citation_store(spark, d, view) -> CitationStore:
    """Findings added in three batches, one of them twice."""
    store = CitationStore(spark, scratch_path(spark, "citations"))
    third = F.pmod(F.xxhash64("pmcid", "synid", "context", "source_file"), F.lit(3))
    for k in (0, 1, 1, 2):
        store.add(view.where(third == k), f"batch {k}")
    return store


@query("citations_kept")
def q_citations_kept(spark, d):
    return citation_store(spark, d, fx.gaps_v(spark, d)).citations()


@query("counts_kept")
def q_counts_kept(spark, d):
    """Combine statistics and summary of the batches, from counts that every batch only adds to."""
    t = citation_store(spark, d, fx.batches_v(spark, d)).totals()
    return t.select(F.col("rows").alias("rows_before"), F.col("distinct").alias("rows_after"), F.col("unique_ids").alias("unique_synids"),
                    "files", "documents", F.col("rows").alias("mentions"), "unique_ids")


# --------------------------------------------------------- enrichment -------

@query("catalog_names")
def q_catalog_names(spark, d):
    return enrich.catalog_names(fx.catalog_v(spark, d), fx.app_v(spark, d), CFG)


def portals(spark, d) -> DataFrame:
    """Looked up for entities and parents, old entries and new: staged once."""
    return stage(enrich.portal_table(fx.catalog_v(spark, d), fx.app_v(spark, d), CFG), scratch_path(spark, "portals"))


@query("portal_resolve")
def q_portal_resolve(spark, d):
    r = enrich.portal_resolve(fx.entity_v(spark, d), portals(spark, d), CFG)
    return r.select("id", "parent_id", "repository", "portal_link")


def landed_headers(spark, d) -> str:
    """Entity headers as a service's responses: two generations, the older with other names, and bad lines."""
    root = scratch_path(spark, "landed-headers")
    e = fx.entity_v(spark, d)
    chunk = F.floor(F.substring("id", 4, 20).cast("bigint") / 100)
    header = F.struct("id", "name", F.col("benefactor_id").alias("benefactorId"), F.col("created_on").alias("createdOn"), F.lit("x").alias("etag"))
    for name, rows in (("a", e.withColumn("name", F.concat(F.lit("old "), "name"))), ("b", e)):
        lines = rows.groupBy(chunk.alias("chunk")).agg(F.to_json(F.struct(F.collect_list(header).alias("results"))).alias("value"))
        bad = lines.select(F.concat(F.lit("bad "), F.col("chunk").cast("string")).alias("value"))
        lines.select("value").unionByName(bad).write.text(f"{root}/{name}")
    return f"{root}/*"


@query("entity_headers")
def q_entity_headers(spark, d):
    return read_entity_headers(spark, landed_headers(spark, d))


@query("portal_landed")
def q_portal_landed(spark, d):
    """The portals of landed entities (``portal_resolve`` from the service's responses)."""
    r = enrich.portal_resolve(read_entity_headers(spark, landed_headers(spark, d)), portals(spark, d), CFG)
    return r.select("id", "parent_id", "repository", "portal_link")


def old_cache(spark, d, portal) -> DataFrame:
    """A cache left by an earlier run: entities dated before the 15th, with names since changed."""
    e = fx.entity_v(spark, d).where(F.col("created_on") < "2024-01-15")
    m = enrich.entity_meta(e, portal, CFG)
    m = m.withColumn("name", F.concat(F.lit("cached "), "name")).withColumn("description", F.col("name"))
    return read_entity_meta(spark, write_version(m, scratch_path(spark, "entity-meta")))


def cited_pairs(spark, d) -> DataFrame:
    """(synid, pmcid) pairs of the stored results; the ids to describe come from these too."""
    return summarize.citation_pairs(fx.findings_v(spark, d))


def refreshed_cache(spark, d, refresh=False, pairs=None) -> DataFrame:
    p = portals(spark, d)
    pairs = cited_pairs(spark, d) if pairs is None else pairs
    return enrich.refresh_cache(pairs, old_cache(spark, d, p), fx.entity_v(spark, d), p, CFG, refresh)


@query("cache_miss")
def q_cache_miss(spark, d):
    path = write_version(refreshed_cache(spark, d), scratch_path(spark, "entity-meta"))
    return read_version(spark, path)


@query("cache_refresh")
def q_cache_refresh(spark, d):
    path = write_version(refreshed_cache(spark, d, refresh=True), scratch_path(spark, "entity-meta"))
    return read_entity_meta(spark, path)


@query("cache_swap")
def q_cache_swap(spark, d):
    """The cache as its committed version: an old one, a refresh, and a write that never got to its commit."""
    p, root = portals(spark, d), scratch_path(spark, "meta-versions")
    cache = VersionedTable(spark, root)
    cache.replace(old_cache(spark, d, p))
    jobs.refresh_metadata(spark, cited_pairs(spark, d), fx.entity_v(spark, d), p, root, CFG)
    cache.write(fx.entity_v(spark, d))
    return read_entity_meta(spark, root)


@query("search_entries")
def q_search_entries(spark, d):
    return enrich.search_entries(cited_pairs(spark, d), refreshed_cache(spark, d), CFG)


@query("inaccessible")
def q_inaccessible(spark, d):
    return enrich.inaccessible(cited_pairs(spark, d), refreshed_cache(spark, d))


@query("resource_list")
def q_resource_list(spark, d):
    path = scratch_path(spark, "resources")
    rows = resource_rows(fx.gaps_v(spark, d), PROVIDER_ID, CFG)
    write_csv(rows, path)
    back = spark.read.schema(rows.schema).option("header", True).option("escape", '"').csv(path)
    return back.fillna("", ["SubjectType"])       # CSV has one way to write null and empty


# ------------------------------------------- staged files: sources & sinks ---
# These queries write derived data below the shared checkpoint folder and read it back,
# so the scan or sink itself is what is checked.

def _stage_corpus(spark, d) -> str:
    path = scratch_path(spark, "corpus")
    write_corpus(fx.articles_xml_v(spark, d), path)
    return path


@query("article_scan")
def q_article_scan(spark, d):
    return read_articles(spark, _stage_corpus(spark, d))


@query("findings_csv_roundtrip")
def q_findings_csv_roundtrip(spark, d):
    path = scratch_path(spark, "findings-csv")
    # by batch, so that not every task writes a file of every batch
    write_csv(fx.findings_v(spark, d).hint("rebalance", "source_file"), path, partition_by="source_file")
    return read_findings_csv(spark, path)


@query("link_feed")
def q_link_feed(spark, d):
    path = scratch_path(spark, "links")
    feeds.write_link_feed(feeds.link_rows(fx.findings_v(spark, d), PROVIDER_ID, CFG), path, compression="gzip")
    return feeds.flatten_links(feeds.read_link_feed(spark, path))


@query("feed_validate")
def q_feed_validate(spark, d):
    good, bad = scratch_path(spark, "links-good"), scratch_path(spark, "links-bad")
    # both feeds are written from the same distinct links: found once
    rows = stage(feeds.link_rows(fx.findings_v(spark, d), PROVIDER_ID, CFG), scratch_path(spark, "link-rows"))
    feeds.write_link_feed(rows, good, compression="gzip")
    feeds.write_link_structs(feeds.link_structs(rows).withColumnRenamed("record", "invalid_element"), bad, compression="gzip")
    out = []
    for name, p in (("good", good), ("bad", bad)):
        r = feeds.read_link_feed(spark, p, feeds.LINKS_XSD)
        out.append(r.select(F.lit(name).alias("feed"), feeds.row_valid().alias("valid"),
                            F.col("record.id").alias("record_id")))
    return (out[0].unionByName(out[1]).groupBy("feed", "valid")
                  .agg(F.count(F.lit(1)).alias("links"), F.count("record_id").alias("with_record")))


@query("input_audit")
def q_input_audit(spark, d):
    root = scratch_path(spark, "inputs")
    write_corpus(fx.articles_xml_v(spark, d), f"{root}/corpus")
    f = fx.findings_v(spark, d)
    write_csv(f.hint("rebalance", "source_file"), f"{root}/batches", partition_by="source_file")
    a = audit_files(spark, root)
    kind = F.when(F.col("path").contains("/corpus/"), F.lit("corpus")).otherwise(F.lit("batches"))
    # a batch may be written in several files
    batch = F.regexp_extract("path", "source_file=([^/]*)", 1)
    return a.groupBy(kind.alias("kind"), "ext", "accepted", "reason").agg(F.count_distinct(batch).alias("files"))


def written_feed(spark, d, least=1) -> str:
    pairs = stage(cited_pairs(spark, d), scratch_path(spark, "cited-pairs"))
    # the entries are used four times by the feed lines (count, body, refs, footer): stage them once
    entries = stage(enrich.search_entries(pairs, refreshed_cache(spark, d, pairs=pairs), CFG), scratch_path(spark, "entries"))
    path = scratch_path(spark, "search-feed")
    lines = feeds.search_feed_lines(entries, pairs, "Datasets", "Datasets cited in articles", "2026-01-01")
    feeds.write_search_feed(lines, path, staging=scratch_path(spark, "feed-lines"), least=least)
    return path


@query("search_feed")
def q_search_feed(spark, d):
    return feeds.read_feed_lines(spark, written_feed(spark, d))


@query("search_feed_order")
def q_search_feed_order(spark, d):
    """Every line with its place in the whole document (written as several shards)."""
    doc = feeds.read_feed_document(spark, written_feed(spark, d, FEED_SHARDS))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = doc.groupBy("shard").agg(F.count(F.lit(1)).alias("lines"))     # one row a shard
    offsets = shards.select("shard", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("offset"))
    return doc.join(F.broadcast(offsets), "shard").select((F.col("offset") + F.col("line_no")).alias("n"), "line")


@query("feed_check")
def q_feed_check(spark, d):
    """The whole-document check on a feed of several shards, as written and with three kinds of damage. What is returned
    are rows of the driver, so a feed goes when it is checked, with what its write shuffled."""
    with job_scratch(spark), brief_shuffles(spark):
        return reduce(DataFrame.unionByName, _checked_feeds(spark, d))


def _checked_feeds(spark, d) -> list[DataFrame]:
    pairs = stage(cited_pairs(spark, d), scratch_path(spark, "cited-pairs"))
    entries = stage(enrich.search_entries(pairs, refreshed_cache(spark, d, pairs=pairs), CFG), scratch_path(spark, "entries"))
    lines = stage(feeds.search_feed_lines(entries, pairs, "Datasets", "Datasets cited in articles", "2026-01-01"), scratch_path(spark, "feed-lines"))
    count = F.when(F.col("line").contains("<entry_count>"), F.lit("  <entry_count>0</entry_count>")).otherwise(F.col("line"))
    made = {"whole": lines, "open entry": lines.where("line <> '      </cross_references>'"), "miscounted": lines.withColumn("line", count),
            "missing shard": lines}
    out = []
    for name, rows in made.items():
        with job_scratch(spark):
            path = scratch_path(spark, "checked-feed")
            feeds.write_search_feed(rows, path, least=FEED_SHARDS)
            shards = sorted(r.shard for r in feed_check.write_manifest(spark, path).collect())
            if name == "missing shard":
                Files(spark, path).remove(f"{path}/{shards[1]}")
            checked = feed_check.check_feed(spark, path).select(F.lit(name).alias("feed"), "check", "ok")
        # what a lost shard leaves may fit together by chance: only the manifest surely tells
        out.append(checked.where("check = 'shards'") if name == "missing shard" else checked)
    return out


@query("stream_coverage")
def q_stream_coverage(spark, d):
    """Coverage by file kept by the stream over two deliveries."""
    src, out, ck = (scratch_path(spark, n) for n in ("corpus-inbox", "stream-out", "stream-ck"))
    arts = fx.articles_xml_v(spark, d)
    half = table(spark, d, "documents").agg(F.max("doc_id")).first()[0] // 200 * 100
    for part in (F.col("doc_id") < half, F.col("doc_id") >= half):
        write_corpus(arts.where(part), src, mode="append")
        ingest_corpus(spark, src, out, ck)
    return stream_coverage(spark, out)


@query("stream_ingest")
def q_stream_ingest(spark, d):
    src, out, ck = (scratch_path(spark, n) for n in ("corpus-inbox", "stream-out", "stream-ck"))
    arts = fx.articles_xml_v(spark, d)
    english = F.col("lang") == "en"
    # two deliveries into the same folders: the second run must pick up only the new files
    write_corpus(arts.where(english), src)
    ingest_corpus(spark, src, out, ck)
    write_corpus(arts.where(~english), src, mode="append")
    ingest_corpus(spark, src, out, ck)
    return spark.read.parquet(out).select("source_file", "pmcid", "synid", "context")


@query("stream_rejects")
def q_stream_rejects(spark, d):
    src, out, bad, ck = (scratch_path(spark, n) for n in ("corpus-inbox", "stream-out", "stream-bad", "stream-ck"))
    write_corpus(fx.articles_xml_v(spark, d), src)
    ingest_corpus(spark, src, out, ck, window=WINDOW_SMALL, case_rule="fold", rejects_path=bad)
    found = spark.read.parquet(out).groupBy("source_file").agg(F.count(F.lit(1)).alias("findings"))
    refused = spark.read.parquet(bad).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rejects"), F.count_if(F.col("reason").startswith("ParseError")).alias("with_reason"))
    return found.join(refused, "source_file", "full").select(
        "source_file", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("findings", "rejects", "with_reason")])


# ------------------------------------------------------------------ jobs ---

@query("incremental_run")
def q_incremental_run(spark, d):
    """Two deliveries through the batch job: the lower half of the corpus files, then all of them."""
    corpus, results, position, out = (scratch_path(spark, n) for n in ("job-corpus", "job-results", "job-position", "job-out"))
    arts = fx.articles_xml_v(spark, d)
    half = table(spark, d, "documents").agg(F.max("doc_id")).first()[0] // 200 * 100
    write_corpus(arts.where(F.col("doc_id") < half), corpus)
    jobs.run_incremental(spark, corpus, results, position, out, files_per_slice=JOB_SLICE)
    write_corpus(arts.where(F.col("doc_id") >= half), corpus, mode="append")
    jobs.run_incremental(spark, corpus, results, position, out, files_per_slice=JOB_SLICE)
    return read_results(spark, results)


@query("incremental_slices")
def q_incremental_slices(spark, d):
    """Articles in two files, whose names do not sort as their numbers do, through the job in small slices: the
    file that comes first by name wins whatever the slices are."""
    corpus, results = scratch_path(spark, "job-corpus"), scratch_path(spark, "job-results")
    write_corpus(fx.articles_xml_v(spark, d), corpus)
    write_corpus(fx.copied_articles_v(spark, d), corpus, mode="append")
    n = table(spark, d, "documents").select(fx.corpus_file_of("doc_id").alias("f")).distinct().count()
    jobs.run_incremental(spark, corpus, results, files_per_slice=-(-n // 2))
    return read_results(spark, results)


@query("combine_job")
def q_combine_job(spark, d):
    src, out = scratch_path(spark, "batches-csv"), scratch_path(spark, "combined")
    write_csv(fx.batches_v(spark, d).hint("rebalance", "source_file"), src, partition_by="source_file")
    jobs.combine_batches(spark, src, out)
    return (spark.read.schema(schemas.FINDINGS).option("header", True).option("escape", '"').csv(f"{out}/combined"))


@query("stream_append")
def q_stream_append(spark, d):
    inbox, table_path, ck = (scratch_path(spark, n) for n in ("inbox", "results", "append-ck"))
    init_results_table(fx.results_v(spark, d), table_path)
    b = fx.batches_v(spark, d)
    early = F.col("source_file") == "PMC0_PMC0.xml.gz"
    # two deliveries: the early batch file first, the others a run later
    write_csv(b.where(early).hint("rebalance", "source_file"), inbox, partition_by="source_file", mode="append")
    append_results(spark, inbox, table_path, ck)
    write_csv(b.where(~early).hint("rebalance", "source_file"), inbox, partition_by="source_file", mode="append")
    append_results(spark, inbox, table_path, ck)
    return (spark.read.parquet(table_path).where(F.col("batch") != "initial")
                 .select("pmcid", "synid", "context", "source_file"))


@query("stream_keyed")
def q_stream_keyed(spark, d):
    """``stream_append`` with the stored articles as the stream's state."""
    inbox, table_path, ck = (scratch_path(spark, n) for n in ("inbox", "results", "keyed-ck"))
    b = fx.batches_v(spark, d)
    early = F.col("source_file") == "PMC0_PMC0.xml.gz"
    for part in (early, ~early):
        write_csv(b.where(part).hint("rebalance", "source_file"), inbox, partition_by="source_file", mode="append")
        append_keyed(spark, inbox, table_path, ck, stored=fx.results_v(spark, d))
    return spark.read.parquet(table_path).select("pmcid", "synid", "context", "source_file")
