from __future__ import annotations

import pytest

from tidemark.config import (
    AppendTable, PartitionTable, Scd2Table, StaticTable, select_tables, table_from_mapping,
)


def test_defaults():
    assert PartitionTable("t").partition_column == "COBID"
    scd = Scd2Table("t", ("id",))
    assert (scd.last_modified, scd.is_latest, scd.order) == ("LastModified", "IsLatest", ("LastModified",))
    assert StaticTable("t").hash_algorithm == "hashbytes_sha256"
    assert StaticTable("t").load_strategy == "replace"


def test_names_are_trimmed():
    assert PartitionTable(" t ", " day ").partition_column == "day"
    assert Scd2Table("t", (" id ", " ")).keys == ("id",)
    assert Scd2Table("t", "id").keys == ("id",)


@pytest.mark.parametrize(
    "build",
    [
        lambda: PartitionTable(" "),
        lambda: PartitionTable("t", ""),
        lambda: PartitionTable("t", initial_load_count=0),
        lambda: Scd2Table("t", ()),
        lambda: Scd2Table("t", (" ",)),
        lambda: Scd2Table("t", ("a", "a")),
        lambda: Scd2Table("t", ("a",), last_modified=" "),
        lambda: Scd2Table("t", ("a",), mode="other"),
        lambda: Scd2Table("t", ("a",), initial_load_days=-1),
        lambda: Scd2Table("t", ("a",), overlap_seconds=0),
        lambda: Scd2Table("t", ("a",), overlap_seconds=5, mode="append"),
        lambda: StaticTable("t", load_strategy="upsert"),
        lambda: StaticTable("t", load_strategy="merge"),
        lambda: StaticTable("t", hash_algorithm="crc"),
        lambda: StaticTable("t", allow_deletes=True),
        lambda: StaticTable("t", force_reload_after_days=0),
        lambda: AppendTable("t", ""),
    ],
)
def test_wrong_descriptions(build):
    with pytest.raises(ValueError):
        build()


def test_tracked_columns():
    table = Scd2Table("t", ("id",), end_date="ends", tie_break=("seq",))
    columns = ["id", "a", "b", "seq", "LastModified", "IsLatest", "ends"]
    assert table.tracked_in(columns) == ["a", "b"]
    assert Scd2Table("t", ("id",), tracked=("a",)).tracked_in(columns) == ["a"]


def test_mapping():
    table = table_from_mapping({"kind": "scd", "table": "t", "keys": ["a", "b"]})
    assert table == Scd2Table("t", ("a", "b"))
    for bad in ({"table": "t"}, {"kind": "cube", "table": "t"}, {"kind": "static", "table": "t", "x": 1}):
        with pytest.raises(ValueError):
            table_from_mapping(bad)


def test_selection():
    tables = [PartitionTable("facts"), Scd2Table("people", ("id",)), StaticTable("codes")]
    assert [t.table for t in select_tables(tables)] == ["codes", "people", "facts"]
    assert [t.table for t in select_tables(tables, kinds=["scd"])] == ["people"]
    assert [t.table for t in select_tables(tables, names=["facts"])] == ["facts"]
    with pytest.raises(ValueError, match="more than once"):
        select_tables([*tables, StaticTable("codes")])
    with pytest.raises(ValueError, match="no such"):
        select_tables(tables, names=["other"])
    with pytest.raises(ValueError, match="unknown kinds"):
        select_tables(tables, kinds=["cube"])
