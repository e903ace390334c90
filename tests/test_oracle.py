"""Every query of the library against its DuckDB oracle (the driver's gate),
at sf0.001 to stay quick: same rows, column types and values. The training-data
queries have their own tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from covtab.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    s_tbl = entry.queries()[name](spark, SF).toArrow()
    d_tbl = con.sql(entry.oracle_sql()[name]).arrow()
    if hasattr(d_tbl, "read_all"):
        d_tbl = d_tbl.read_all()
    res = compare(s_tbl, d_tbl)
    assert res["rows_match"] and res["schema_match"] and res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["study_name", "qtl_group", "seqnames", "start", "end", "strand",
                          "score", "sample_id"]
    assert df.count() > 0
