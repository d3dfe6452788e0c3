"""Global places and running sums against Python's sort."""

from pyspark.sql import functions as F

from accmine.operators.ordering import with_ordinal


def test_places_and_sums_over_several_ranges(spark):
    rows = [((k * 7919) % 501, f"n{k:03d}", k % 5) for k in range(500)]
    df = spark.createDataFrame(rows, "a long, b string, w long").repartition(7)
    for per_task, one_task in ((20, 0), (100_000, 0), (20, 10_000)):
        got = with_ordinal(df, [F.desc("a"), "b"], "place", {"before": "w"}, rows_per_task=per_task, one_task=one_task).collect()
        total = 0
        for place, (row, r) in enumerate(zip(sorted(rows, key=lambda x: (-x[0], x[1])), sorted(got, key=lambda r: r.place))):
            assert (r.a, r.b, r.w, r.place, r.before) == (*row, place, total)
            total += row[2]


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", None)], "k string, w long")
    for one_task in (0, 10_000):
        got = {r.k: (r.ordinal, r.s) for r in with_ordinal(df, [F.asc_nulls_last("k")], sums={"s": "w"}, one_task=one_task).collect()}
        assert got == {"a": (0, 0), "b": (1, 0), None: (2, 1)}
        assert with_ordinal(df.where("false"), ["k"], one_task=one_task).collect() == []
