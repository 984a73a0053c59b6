"""Every query with an oracle must equal its DuckDB SQL on the small dataset (driver-style compare)."""

import pytest

import __spark_entry__ as E
import tools.parity as TP
from tests.conftest import SMALL
from tools.parity import compare, duck

TP.STRICT = True   # both sides round to 6 places; the rounded doubles must be identical

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SMALL).toPandas()
    dp = con.sql(ORACLES[name]).df()
    assert compare(name, sp, dp) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert {"model", "pr_auc", "roc_auc", "rank", "threshold"} <= set(df.columns)
