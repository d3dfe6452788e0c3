"""Declared schemas of the library's tables."""

from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, B = StringType(), LongType(), BooleanType()

SECTIONS = _s(("ok", B), ("pmc_id", S), ("title", S), ("abstract", S), ("body", S), ("back", S), ("reason", S))
FINDINGS = _s(("pmcid", S), ("synid", S), ("context", S), ("source_file", S))
FINDINGS_CSV = _s(("pmcid", S), ("synid", S), ("context", S))
REJECTS = _s(("source_file", S), ("xml", S), ("reason", S))
RESULTS = _s(("pmcid", S), ("synid", S), ("context", S))
RUN_FILES = _s(("source_file", S), ("run", S))
ENTITY_META = _s(("id", S), ("name", S), ("description", S), ("created_on", S),
                 ("repository", S), ("portal_link", S))
WATERMARK = _s(("last_processed_pmc_id", S), ("start_pmc", L), ("updated_at", S))
