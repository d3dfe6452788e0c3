"""Write docs/plans.md: the physical plan of every registered query (static plan, before AQE)."""

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from accmine.plans.queries import QUERIES  # noqa: E402
from accmine.session import build_session  # noqa: E402


def main(sf_dir, out="docs/plans.md"):
    spark = build_session("local[8]", 16)
    parts = [f"# Physical plans\n\nGenerated by `python tools_plans.py {sf_dir}` (expression ids removed, long "
             "lines cut). Staged queries write their inputs first, so their plans start at the read-back.\n"]
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with redirect_stdout(buf):
            fn(spark, sf_dir).explain()
        text = re.sub(r"#\d+L?", "", buf.getvalue())
        text = re.sub(r"\[plan_id=\d+\]", "", text)
        lines = [ln[:180] for ln in text.splitlines() if ln.strip()]
        parts.append(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    # the production mining job (jobs.mine_corpus) over a staged gzip corpus
    from accmine.operators.articles import findings_from_articles
    from accmine.operators.parse import parse_articles
    from accmine.session import scratch_path
    from accmine.sources import fixtures as fx
    from accmine.sources.corpus import read_articles, write_corpus
    corpus = scratch_path(spark, "plan-corpus")
    write_corpus(fx.articles_xml_v(spark, sf_dir), corpus)
    job = findings_from_articles(parse_articles(read_articles(spark, corpus), "xml", ("source_file",)))
    buf = io.StringIO()
    with redirect_stdout(buf):
        job.explain()
    text = re.sub(r"\[plan_id=\d+\]", "", re.sub(r"#\d+L?", "", buf.getvalue()))
    parts.insert(1, "## jobs.mine_corpus (production path: gzip scan, spread, UDF, mining)\n\n```\n"
                 + "\n".join(ln[:180] for ln in text.splitlines() if ln.strip()) + "\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
