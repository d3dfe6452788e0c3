"""Results table, deduplication, summaries and enrichment on small frames."""

from accmine.operators import dedup, enrich, incremental, summarize

FOUND = "pmcid string, synid string, context string, source_file string"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()),
                  key=lambda t: tuple((v is not None, v) for v in t))


def batch(spark, *rows_):
    return spark.createDataFrame([(f"pmc:PMC{a}", f"syn{s}", c, f) for a, s, c, f in rows_], FOUND)


def test_stored_articles_are_skipped_whole(spark):
    f = batch(spark, (4, 10, "c", "f"), (5, 11, "c", "f"), (5, 12, "c", "f"), (6, 13, "c", "f"))
    stored = spark.createDataFrame([("pmc:PMC5",), ("pmc:PMC5",), ("pmc:PMC9",)], "pmcid string")
    assert rows(incremental.new_rows(f, stored), "pmcid") == [("pmc:PMC4",), ("pmc:PMC6",)]
    assert incremental.new_rows(f, stored, check_duplicates=False).count() == 4
    assert incremental.new_rows(f, stored.where("false")).count() == 4


def test_the_first_batch_of_an_article_wins(spark):
    f = batch(spark, (1, 1, "late", "PMC9_PMC9.xml.gz"), (1, 2, "early", "PMC10_PMC19.xml.gz"), (1, 2, "early", "PMC10_PMC19.xml.gz"),
              (2, 3, "only", "PMC9_PMC9.xml.gz"), (3, 4, "stored", "PMC9_PMC9.xml.gz"))
    stored = spark.createDataFrame([("pmc:PMC3",)], "pmcid string")
    got = incremental.first_batch_wins(f, stored)
    assert got.columns == f.columns        # "PMC10…" sorts before "PMC9…": name order, not number order
    assert rows(got, "synid", "context") == [("syn2", "early"), ("syn2", "early"), ("syn3", "only")]
    assert rows(incremental.first_batch_wins(f, stored, check_duplicates=False), "synid") == [("syn2",), ("syn2",), ("syn3",), ("syn4",)]


def test_combine(spark):
    f = batch(spark, (1, 1, None, "c"), (1, 1, None, "b"), (1, 1, "x", "c"), (2, 1, "x", "a"), (2, 2, "x", "a"), (2, 2, "x", "a"))
    assert rows(dedup.combine_dedup(f)) == [("pmc:PMC1", "syn1", None, "b"), ("pmc:PMC1", "syn1", "x", "c"),
                                            ("pmc:PMC2", "syn1", "x", "a"), ("pmc:PMC2", "syn2", "x", "a")]
    assert dedup.combine_stats(f).first().asDict() == {"rows_before": 6, "rows_after": 4, "unique_synids": 2, "files": 3}
    assert dedup.combine_stats(f.where("false")).first().asDict() == {"rows_before": 0, "rows_after": 0, "unique_synids": 0, "files": 0}
    assert dedup.combine_dedup(f.where("false")).count() == 0


def test_summaries(spark):
    f = batch(spark, *[(k % 3, 100 + k % 4, "c", "f") for k in range(17)])
    assert tuple(summarize.summary(f).first()) == (3, 17, 4)
    assert rows(summarize.doc_counts(f)) == [("pmc:PMC0", 6, 4), ("pmc:PMC1", 6, 4), ("pmc:PMC2", 5, 4)]
    assert [tuple(r) for r in summarize.top_ids(f, 3).collect()] == [("syn100", 5), ("syn101", 4), ("syn102", 4)]


def test_one_finding_of_an_id_in_a_document(spark):
    f = spark.createDataFrame([("d", 3, "s", "third"), ("d", 1, "s", "first"), ("d", 2, "t", "second"), ("e", 0, "s", "other")],
                              "pmcid string, pos int, synid string, context string")
    assert rows(dedup.first_per_document(f), "pmcid", "synid", "context") == [("d", "s", "first"), ("d", "t", "second"), ("e", "s", "other")]


def test_rows_without_keys(spark):
    f = spark.createDataFrame([("pmc:PMC1", "a"), ("PMC1", "a"), ("pmc:", "b"), ("", "c"), (None, "d"), ("pmc:PMC2", ""), ("pmc:PMC2", None)],
                              "pmcid string, synid string")
    assert rows(dedup.distinct_links(f), "pmcid", "synid") == [("", "b"), ("PMC1", "a")]
    assert rows(summarize.citations_by_id(f), "synid", "pmcid", "n_articles") == [("a", "PMC1", 1)]


def test_files_positions_and_listings(spark):
    html = ('<a href="../">up</a><a href="PMC8_PMC9.xml.gz">x</a><a href="PMC8_PMC9.xml.gz.md5">x</a>'
            '<a href="PMC10_PMC99.xml.gz">x</a><a href="PMC8_PMC9.filelist.csv">x</a><a href="readme.xml.gz">x</a>')
    names = incremental.listed_files(spark.createDataFrame([(html,), (html,)], "html string"))
    assert rows(names) == [("PMC10_PMC99.xml.gz",), ("PMC8_PMC9.xml.gz",), ("readme.xml.gz",)]
    files = incremental.file_catalog(names)
    assert [r.start_pmc for r in incremental.resume_files(files).collect()] == [8, 10]
    assert [r.start_pmc for r in incremental.resume_files(files, "PMC9").collect()] == [10]
    assert [r.start_pmc for r in incremental.resume_files(files, "PMC8_PMC9.xml.gz", 1).collect()] == [8]
    assert [r.start_pmc for r in incremental.resume_files(files, "readme.xml.gz").collect()] == [8, 10]
    assert incremental.resume_files(files, "PMC11").count() == 0
    assert incremental.watermark(names).first().last_processed_pmc_id == "PMC10"
    assert incremental.watermark(names.where("false")).count() == 0


CAT, APP = "id string, app_id string, link string, ord long", "app_id string, friendly_name string, ord long"


def test_the_last_catalogue_and_app_row_counts(spark):
    cat = spark.createDataFrame([("s1", "a", "https://p/1", 1), ("s1", "b", None, 2), ("s2", None, "", 1), ("s3", "c", "https://p/3", 5)], CAT)
    apps = spark.createDataFrame([("a", "A", 1), ("b", "Zeta", 1), ("b", "Alpha", 2)], APP)
    assert rows(enrich.catalog_names(cat, apps), "id", "app_id", "link", "repository") == [
        ("s1", "b", None, "Alpha"), ("s2", "", None, "Repository"), ("s3", "c", "https://p/3", "Repository")]


def test_own_entry_before_the_parents(spark):
    ent = spark.createDataFrame([("syn1", "one", 9, "2022-02-02T01:00:00Z"), ("syn2", "", 9, None), ("syn3", None, 0, None)],
                                "id string, name string, benefactor_id long, created_on string")
    cat = spark.createDataFrame([("syn1", "own", None, 1), ("syn9", "up", "https://p/9", 2)], CAT)
    apps = spark.createDataFrame([("own", "Own", 1), ("up", "Up", 1)], APP)
    cfg = enrich.PortalConfig(default_repository="None named")
    portals = enrich.portal_table(cat, apps, cfg)
    assert rows(enrich.portal_resolve(ent, portals, cfg), "id", "parent_id", "repository", "portal_link") == [
        ("syn1", "syn9", "Own", None), ("syn2", "syn9", "Up", "https://p/9"), ("syn3", None, "None named", None)]
    meta = {r.id: (r.name, r.created_on) for r in enrich.entity_meta(ent, portals, cfg).collect()}
    assert meta == {"syn1": ("one", "2022-02-02"), "syn2": ("syn2", ""), "syn3": ("syn3", "")}
    ids = spark.createDataFrame([("syn1",), ("syn2",), ("syn8",)], "synid string")
    old = enrich.entity_meta(ent, portals, cfg).where("id = 'syn1'").replace("one", "kept")
    fresh = enrich.refresh_cache(ids, old, ent, portals, cfg)
    assert rows(fresh, "id", "name") == [("syn1", "kept"), ("syn2", "syn2")]
    assert rows(enrich.refresh_cache(ids, old, ent, portals, cfg, refresh=True), "id", "name") == [("syn1", "one"), ("syn2", "syn2")]
    assert rows(enrich.inaccessible(ids, fresh)) == [("syn8",)]


def test_batches_of_different_columns(spark):
    a, b = spark.createDataFrame([("p", 1)], "x string, y int"), spark.createDataFrame([("q", "w")], "x string, z string")
    assert rows(dedup.union_batches([a, b]), "x", "y", "z") == [("p", 1, None), ("q", None, "w")]


def test_coverage(spark):
    from accmine.operators.articles import coverage
    parsed = spark.createDataFrame([
        ("a", True, "PMC1", "syn5550000"), ("a", True, "PMC2", ""), ("a", False, None, None), ("a", True, "PMC4", "syn5550000 syn5550001 syn5550002"),
        ("b", True, None, "syn5550000"), ("b", True, "PMC6", "SYN5550000")], "source_file string, ok boolean, pmc_id string, text string")
    assert rows(coverage(parsed), "source_file", "articles", "parsed", "with_id", "articles_with_findings", "findings") == [
        ("a", 4, 3, 3, 2, 4), ("b", 2, 2, 1, 0, 0)]
