"""covtab: genome coverage tables on Spark.

Turns per-sample coverage tracks (BigWig) into sorted, analysis-ready Parquet
tables — one per (study, sample group) — and validates and inspects them, all as
Spark DataFrame jobs.

Layout
------
functions/  Column expressions: chromosome names and ranks, interval conversion.
sources/    File discovery, manifests, the BigWig scan, the driver-table fixture.
operators/  DataFrame -> DataFrame operators: convert, validate, row-order check, inspect.
sinks/      Sorted Parquet writer and manifest writer.
plans/      User-level jobs (convert a directory / manifest / study, region query)
            and the registered fixture queries.
streaming/  Incremental conversion of manifest rows as they arrive.
"""

from covtab.region import RegionSpec
from covtab.schema import COVERAGE_SCHEMA, OUTPUT_COLUMNS

__all__ = ["RegionSpec", "COVERAGE_SCHEMA", "OUTPUT_COLUMNS"]
