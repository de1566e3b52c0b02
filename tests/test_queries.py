"""Every registered query against its SQL twin, and what its plan may not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from suite import ALL_CASES
from tests.conftest import SF_DIR
from tests.oracle import difference


@pytest.fixture(autouse=True, scope="module")
def compiled(spark):
    """These queries run the way they do in production, with generated code."""
    settings = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    before = [spark.conf.get(s) for s in settings]
    for setting, value in zip(settings, ("true", "FALLBACK"), strict=True):
        spark.conf.set(setting, value)
    yield
    for setting, value in zip(settings, before, strict=True):
        spark.conf.set(setting, value)


@pytest.mark.parametrize("key", list(ALL_CASES))
def test_query_matches_sql(key, spark, sql):
    case = ALL_CASES[key]
    df = case.run(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Python|Pandas|Arrow", plan), "row work left the JVM"
    if case.sql is None:
        assert df.columns and df.count() >= 0
    else:
        assert difference(df, sql, case.sql) is None


def test_contract_is_complete():
    # the text preparation queries come on top where their folders are there
    found, with_sql = contract.queries(), contract.oracle_sql()
    assert set(ALL_CASES) <= set(found)
    assert set(with_sql) <= set(found)
    assert set(ALL_CASES) - set(with_sql) == {"table_checksum"}


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "customer", "channel", "status", "modified", "order_no", "is_latest", "valid_from", "valid_to",
    ]
    assert df.count() > 0


def test_results_are_not_empty(sql):
    allowed_empty = {"load_alerts", "scd2_timestamp_ties", "key_candidates", "validate_all"}
    for key, case in ALL_CASES.items():
        if case.sql and key not in allowed_empty:
            cursor = sql.execute(f"SELECT count(*) FROM ({case.sql})")
            assert cursor.fetchall()[0][0] > 0, key
