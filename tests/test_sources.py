"""File sources: text files with encoding fallback (S9), input audit (V1), findings CSV glob."""

import gzip
import os
import random
import tempfile

from accmine.sources.corpus import audit_files, read_findings_csv, read_text_files


def test_text_files_fallback(spark):
    d = tempfile.mkdtemp(prefix="accmine-text-")
    with open(os.path.join(d, "a.txt"), "wb") as fh:
        fh.write("café syn1234567".encode("utf-8"))
    with open(os.path.join(d, "b.txt"), "wb") as fh:
        fh.write("crème brûlée".encode("latin-1"))
    got = {os.path.basename(r.path): (r.text, r.encoding) for r in read_text_files(spark, d).collect()}
    assert got == {"a.txt": ("café syn1234567", "utf-8"), "b.txt": ("crème brûlée", "latin-1")}


def test_audit_order_of_checks(spark):
    d = tempfile.mkdtemp(prefix="accmine-audit-")
    files = {
        "ok.xml": b"<article a='1'/>",
        "ok.txt": "plain text é".encode("utf-8"),
        "ok.xml.gz": gzip.compress(b"<article a='1'/>"),
        "ok.pdf": b"%PDF-1.4 ...",
        "bad.exe": b"MZ\x90\x00",
        "bad.txt": b"\x00\x01\x02\xff\xfe",
        "big.txt": b"x" * 300,
        "tab.txt": b"\x10\x0a line",  # hex '100a' holds '00' across two bytes: still text
    }
    for n, b in files.items():
        with open(os.path.join(d, n), "wb") as fh:
            fh.write(b)
    got = {os.path.basename(r.path): (r.accepted, r.reason) for r in audit_files(spark, d, max_bytes=200).collect()}
    assert got == {"ok.xml": (True, "ok"), "ok.txt": (True, "ok"), "ok.xml.gz": (True, "ok"),
                   "ok.pdf": (True, "ok"), "bad.exe": (False, "extension"), "bad.txt": (False, "type"),
                   "big.txt": (False, "size"), "tab.txt": (True, "ok")}


def _type_ok(data: bytes) -> bool:
    if data[:2] == b"\x1f\x8b" or data[:4] == b"%PDF" or data[:1] == b"<":
        return True
    try:
        return "\0" not in data.decode("utf-8")
    except UnicodeDecodeError:
        return False


def test_audit_in_pieces_equals_whole_files(spark, tmp_path):
    """Verdicts of files read in pieces, some over several splits, against a check of the whole bytes."""
    rng = random.Random(11)
    bits = [b"\n", b">", b"<", b"\r\n", "é€😀".encode(), b"a" * 40, b"\xff", b"\x00", b"%PDF", b"\x1f\x8b", b" "]
    likely = [8, 8, 2, 4, 8, 8, 0.3, 0.3, 1, 1, 8]
    heads = [b"", b"\xef\xbb\xbf", b"\xef\xbb\xbf<", b"<", b"%PDF", b"%PD", b"\n<", b">", b"\x1f\x8b", b"\xef\xbb\xbf%PDF", b"\xef\xbb"]
    want = {}
    for k in range(120):
        name = f"f {k}%20.{rng.choice(['xml', 'TXT', 'html', 'pdf'])}"
        data = rng.choice(heads) + b"".join(rng.choices(bits, likely, k=rng.choice([0, 1, 5, 60])))
        (tmp_path / name).write_bytes(data)
        if data:                              # Spark lists no empty files
            want[name] = (len(data), _type_ok(data))
    assert 10 < sum(ok for _, ok in want.values()) < 110
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        rows = audit_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == len(want)
    assert {os.path.basename(r.path): (r.length, r.accepted) for r in rows} == want


def test_audit_loads_content_of_packed_files_only(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(b"<a/>")
    assert audit_files(spark, str(tmp_path), allowed=(".xml",)).collect()[0].accepted
    plan = audit_files(spark, str(tmp_path), allowed=(".xml", ".txt"))._jdf.queryExecution().executedPlan().toString()
    assert "content:binary" not in plan


def test_findings_csv_glob_and_batch_name(spark):
    d = tempfile.mkdtemp(prefix="accmine-csv-")
    for name, rows in {"results.csv.PMC1_PMC9.xml.gz.csv": ["pmc:PMC1,syn1234567,\"a, b\""],
                       "results.csv.PMC10_PMC19.xml.gz.csv": ["pmc:PMC12,syn7654321,c"],
                       "notes.txt": ["ignored"]}.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write("pmcid,synid,context\n" + "\n".join(rows) + "\n")
    got = sorted(tuple(r) for r in read_findings_csv(spark, d).collect())
    assert got == [("pmc:PMC1", "syn1234567", "a, b", "PMC1_PMC9.xml.gz"),
                   ("pmc:PMC12", "syn7654321", "c", "PMC10_PMC19.xml.gz")]


def test_findings_csv_goes_by_names_and_doubled_quotes(spark, tmp_path):
    (tmp_path / "a.PMC1_PMC2.xml.gz.csv").write_text('context,synid,pmcid,extra\n"a, ""b"" \\",syn1234567,pmc:PMC1,z\n')
    (tmp_path / "b.PMC3_PMC4.xml.gz.csv").write_text('"pmcid","synid"\npmc:PMC3,syn7654321\n')
    got = sorted(tuple(r) for r in read_findings_csv(spark, str(tmp_path)).collect())
    assert got == [("pmc:PMC1", "syn1234567", 'a, "b" \\', "PMC1_PMC2.xml.gz"), ("pmc:PMC3", "syn7654321", None, "PMC3_PMC4.xml.gz")]


def test_written_csv_reads_back(spark, tmp_path):
    from accmine.sinks.feeds import write_csv
    rows = [("pmc:PMC1", "syn1", c, "PMC1_PMC2.xml.gz") for c in ('q "x"', "back \\", 'both \\"', "a,b", "'")]
    df = spark.createDataFrame(rows, "pmcid string, synid string, context string, source_file string")
    write_csv(df, str(tmp_path / "o"), partition_by="source_file")
    assert sorted(tuple(r) for r in read_findings_csv(spark, str(tmp_path / "o")).collect()) == sorted(rows)


def test_the_findings_csv_has_a_file_a_batch(spark, sf_dir):
    from accmine.plans.queries import QUERIES
    back = QUERIES["findings_csv_roundtrip"](spark, sf_dir)
    assert len(back.inputFiles()) == back.select("source_file").distinct().count()      # not one for each task and batch
