"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is executed completely into Spark's ``noop`` sink (nothing is collected). Every query runs
twice: the first (cold) pass pays JIT and Python-worker start-up, which do not grow with the data;
``value``/``queries`` are the second (warm) pass, ``cold`` the first. Plans and listings kept from the
first pass are dropped before the second. ``mine_corpus`` is the batch job over a gzip corpus in which
one article in twenty holds an id; the corpus is staged outside the timing."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from accmine import jobs  # noqa: E402
from accmine.plans.queries import QUERIES  # noqa: E402
from accmine.session import build_session, scratch_path  # noqa: E402
from accmine.sources import fixtures, tables  # noqa: E402
from accmine.sources.corpus import write_corpus  # noqa: E402

HEADLINE = [
    "mention_context",      # documents -> mentions with context (native regex path)
    "xml_mine",             # article XML -> pandas UDF parse -> mining
    "article_scan",         # gzip corpus write + lineSep scan
    "mine_corpus",          # the batch job: scan, exact gate, parse, mine, write
    "stream_ingest",        # corpus stream -> findings (availableNow)
    "first_batch_wins",     # incremental append semantics (agg + join + anti join)
    "combine_dedup",        # batch combine with keep-first
    "citations_by_id",      # per-id citations
    "search_entries",       # cache refresh + enrichment joins
    "link_feed",            # distinct links -> XML feed -> read back
    "search_feed",          # sharded search feed write
    "top_ids",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "16g"})
    corpus = scratch_path(spark, "bench-corpus")
    plain = F.regexp_replace("xml", "(?i)syn([0-9])", "ref$1")
    arts = fixtures.articles_xml_v(spark, sf_dir)
    write_corpus(arts.withColumn("xml", F.when(F.col("doc_id") % 20 == 0, F.col("xml")).otherwise(plain)), corpus)
    run = {n: (lambda n=n: QUERIES[n](spark, sf_dir)) for n in HEADLINE if n in QUERIES}
    run["mine_corpus"] = lambda: jobs.mine_corpus(spark, corpus, scratch_path(spark, "bench-mined"))
    runs = []
    for _ in range(2):
        fixtures.forget()
        tables.forget()
        times = {}
        for name in HEADLINE:
            t0 = time.time()
            run[name]().write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        runs.append(times)
    cold, warm = runs
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "sf": sf, "cold": cold,
                      "cold_total": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
