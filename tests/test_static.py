"""Canonical text, fingerprints, differences and load decisions."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import canonical
from tidemark.operators import static

SCHEMA = "id int, name string, price decimal(10,2)"


def table(spark, *data):
    return spark.createDataFrame([(i, n, Decimal(p)) for i, n, p in data], SCHEMA)


def prints(df, algorithm="hashbytes_sha256"):
    found = canonical.table_fingerprint(df, algorithm=algorithm).first()
    return found["row_count"], found["fingerprint"]


ALGORITHMS = ["checksum", "hashbytes_md5", "hashbytes_sha256"]


def test_text_is_unambiguous(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), ("\\N", "c"), (None, "c"), ("", "c")]
    df = spark.createDataFrame(pairs, "x string, y string")
    texts = [r[0] for r in df.select(canonical.row_text(df)).collect()]
    assert len(set(texts)) == len(pairs)
    assert texts[0] == "a\\|b|c"


def test_text_of_every_type(spark):
    values = spark.sql(
        """SELECT CAST(1.50 AS DECIMAL(5,2)) AS a, TIMESTAMP_NTZ '2024-01-01 00:00:00.5' AS b,
           DATE '2024-01-01' AS c, true AS d, X'0AFF' AS e, 0.5D AS f, CAST(-0.0 AS DOUBLE) AS g,
           TIMESTAMP '1970-01-01 00:00:01' AS h"""
    )
    text = values.select(canonical.row_text(values)).first()[0]
    assert text == "1.50|2024-01-01 00:00:00.5|2024-01-01|true|0AFF|0.5|0.0|1000000"


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_fingerprint_ignores_order_but_not_copies(spark, algorithm):
    data = [(i, f"n{i}", "1.00") for i in range(50)]
    shuffled = random.Random(1).sample(data, len(data))
    base = prints(table(spark, *data), algorithm)
    assert prints(table(spark, *shuffled).repartition(7), algorithm) == base
    doubled = table(spark, *data, *data[:1], *data[:1])
    assert prints(doubled, algorithm)[1] != base[1], "a pair of equal rows must not cancel"
    changed = table(spark, *data[:-1], (49, "n49", "1.01"))
    assert prints(changed, algorithm)[1] != base[1]


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_nulls_have_a_place(spark, algorithm):
    left = spark.createDataFrame([(None, "x")], "a string, b string")
    right = spark.createDataFrame([("x", None)], "a string, b string")
    assert prints(left, algorithm) != prints(right, algorithm)


def test_empty_table_has_a_fingerprint(spark):
    assert prints(table(spark)) == (0, "0")


def test_fingerprint_adds_up_by_hand(spark):
    import hashlib

    texts = ["1|a|1.00", "2|b|2.00"]
    total = sum(int(hashlib.sha256(t.encode()).hexdigest()[:15], 16) for t in texts)
    assert prints(table(spark, (1, "a", "1.00"), (2, "b", "2.00"))) == (2, str(total))


@pytest.fixture
def pair(spark):
    source = table(spark, (1, "a", "1"), (2, "b", "2"), (3, "c", "3"))
    target = table(spark, (1, "a", "1"), (2, "b", "9"), (4, "d", "4"))
    return source, target


def test_diff_and_changes(pair):
    source, target = pair
    assert rows(static.table_diff(source, target, ["id"]), "id", "action") == [
        (1, "unchanged"), (2, "update"), (3, "insert"), (4, "delete"),
    ]
    touched = static.merge_changes(source, target, ["id"])
    assert rows(touched, "id", "name", "action") == [(2, "b", "update"), (3, "c", "insert")]
    assert static.merge_changes(source, target, ["id"], allow_deletes=True).count() == 3


def test_repeated_keys_do_not_multiply(spark):
    source = table(spark, *[(1, "a", "1")] * 3, (2, "b", "2"))
    target = table(spark, *[(1, "a", "1")] * 2, (2, "b", "2"))
    assert rows(static.table_diff(source, target, ["id"])) == [
        (1, 3, 2, "update"), (2, 1, 1, "unchanged"),
    ]


def test_upsert_and_sync(pair):
    source, target = pair
    assert rows(static.upsert(source, target, ["id"]), "id", "name") == [
        (1, "a"), (2, "b"), (3, "c"), (4, "d"),
    ]
    synced = static.sync_with_deletes(source, target, ["id"])
    assert prints(synced) == prints(source)
    found = static.source_target_match(source, synced).first()
    assert not found["row_count_mismatch"] and not found["hash_mismatch"]
    found = static.source_target_match(source, target).first()
    assert not found["row_count_mismatch"] and found["hash_mismatch"]


def test_load_decisions(spark):
    printed = spark.createDataFrame(
        [("new", 1, "1"), ("changed", 1, "2"), ("old", 1, "3"), ("same", 1, "4")],
        "table_name string, row_count bigint, fingerprint string",
    )
    day = dt.datetime(2024, 1, 1)
    states = spark.createDataFrame(
        [("changed", "9", day), ("old", "3", day), ("same", "4", day + dt.timedelta(days=25))],
        "table_name string, last_hash string, last_loaded timestamp_ntz",
    )
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    decided = static.load_decisions(printed, states, now, force_after_days=30)
    assert dict(rows(decided, "table_name", "reason")) == {
        "new": "initial_load", "changed": "hash_changed", "old": "forced_by_age", "same": "unchanged",
    }
    forced = static.load_decisions(printed, states, now, force=True)
    assert forced.where("needs_load").count() == 4
    analysis = static.change_analysis(printed, states, now)
    assert dict(rows(analysis, "table_name", "change_frequency")) == {
        "new": None, "changed": "low", "old": "low", "same": "medium",
    }
