"""What to synchronise: one small frozen description per table pattern."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields

# Names users put into table descriptions.
HASH_ALGORITHMS = ("checksum", "hashbytes_md5", "hashbytes_sha256")
LOAD_STRATEGIES = ("replace", "upsert")
SCD2_MODES = ("collapse", "full_history", "append")


def _name(label: str, value: str) -> str:
    if not value or not value.strip():
        raise ValueError(f"{label} must not be empty")
    return value.strip()


def _columns(label: str, values: Iterable[str] | str | None) -> tuple[str, ...]:
    if isinstance(values, str):
        values = (values,)
    kept = tuple(v.strip() for v in (values or ()) if v and v.strip())
    if len(set(kept)) != len(kept):
        raise ValueError(f"{label} names a column twice")
    return kept


def _set(obj, **values) -> None:
    for key, value in values.items():
        object.__setattr__(obj, key, value)


@dataclass(frozen=True)
class PartitionTable:
    """Grows by whole values of ``partition_column`` (a YYYYMMDD number or a date).

    With ``replace_changed`` every run also compares the content of the partitions both
    sides have, which reads both tables whole; otherwise only the values are compared.
    """

    table: str
    partition_column: str = "COBID"
    initial_load_count: int | None = None
    where: str | None = None
    replace_changed: bool = False
    kind: str = field(default="partition", init=False)

    def __post_init__(self):
        _set(
            self,
            table=_name("table", self.table),
            partition_column=_name("partition_column", self.partition_column),
        )
        if self.initial_load_count is not None and self.initial_load_count <= 0:
            raise ValueError("initial_load_count must be positive")


@dataclass(frozen=True)
class Scd2Table:
    """Keeps versions per business key.

    ``tracked`` lists the attributes whose change makes a new version; left out, it
    is every column that is neither a key nor a control column. ``tie_break`` orders
    rows of one key that carry the same ``last_modified``.

    ``mode`` says what a batch becomes: "collapse" keeps the newest row of each key if it
    differs, "full_history" keeps every distinct version and fits late rows in, "append"
    adds the rows as they come.

    ``overlap_seconds`` makes a run read that much below its mark again, for rows that
    arrive late with a stamp already passed. Only "collapse" can take a row twice.

    ``buckets`` keeps the current rows in that many buckets by key, of which a run reads and
    rewrites those its batch touches. The number stays as it is for the life of a table.
    """

    table: str
    keys: tuple[str, ...]
    last_modified: str = "LastModified"
    is_latest: str = "IsLatest"
    effective_date: str | None = None
    end_date: str | None = None
    tracked: tuple[str, ...] | None = None
    tie_break: tuple[str, ...] = ()
    initial_load_days: int | None = None
    overlap_seconds: int | None = None
    where: str | None = None
    mode: str = "collapse"
    buckets: int | None = None
    kind: str = field(default="scd", init=False)

    def __post_init__(self):
        keys = _columns("keys", self.keys)
        if not keys:
            raise ValueError("at least one business key column is required")
        _set(
            self,
            table=_name("table", self.table),
            keys=keys,
            last_modified=_name("last_modified", self.last_modified),
            is_latest=_name("is_latest", self.is_latest),
            tie_break=_columns("tie_break", self.tie_break),
        )
        if self.tracked is not None:
            _set(self, tracked=_columns("tracked", self.tracked))
        if self.mode not in SCD2_MODES:
            raise ValueError(f"mode must be one of {SCD2_MODES}")
        if self.initial_load_days is not None and self.initial_load_days <= 0:
            raise ValueError("initial_load_days must be positive")
        if self.overlap_seconds is not None:
            if self.overlap_seconds <= 0:
                raise ValueError("overlap_seconds must be positive")
            if self.mode != "collapse":
                raise ValueError("overlap_seconds belongs to the collapse mode")
        if self.buckets is not None and self.buckets <= 0:
            raise ValueError("buckets must be positive")

    @property
    def order(self) -> tuple[str, ...]:
        """Total order of the versions of one key."""
        return (self.last_modified, *self.tie_break)

    @property
    def control(self) -> set[str]:
        """Columns that describe the version rather than the entity."""
        named = {self.is_latest, self.effective_date, self.end_date}
        return {*self.order, *(c for c in named if c)}

    def tracked_in(self, columns: Iterable[str]) -> list[str]:
        if self.tracked is not None:
            return list(self.tracked)
        skip = self.control | set(self.keys)
        return [c for c in columns if c not in skip]


@dataclass(frozen=True)
class StaticTable:
    """A reference table compared as a whole and replaced or upserted.

    With ``lineage`` the stored rows carry the load id and the fingerprint of the source.
    """

    table: str
    primary_keys: tuple[str, ...] = ()
    load_strategy: str = "replace"
    hash_algorithm: str = "hashbytes_sha256"
    force_reload_after_days: int | None = None
    allow_deletes: bool = False
    lineage: bool = False
    where: str | None = None
    kind: str = field(default="static", init=False)

    def __post_init__(self):
        _set(
            self,
            table=_name("table", self.table),
            primary_keys=_columns("primary_keys", self.primary_keys),
        )
        if self.hash_algorithm not in HASH_ALGORITHMS:
            raise ValueError(f"hash_algorithm must be one of {HASH_ALGORITHMS}")
        if self.load_strategy not in LOAD_STRATEGIES:
            raise ValueError(f"load_strategy must be one of {LOAD_STRATEGIES}")
        if self.load_strategy == "upsert" and not self.primary_keys:
            raise ValueError("an upsert needs primary_keys")
        if self.allow_deletes and self.load_strategy != "upsert":
            raise ValueError("allow_deletes belongs to the upsert strategy")
        if self.force_reload_after_days is not None and self.force_reload_after_days <= 0:
            raise ValueError("force_reload_after_days must be positive")


@dataclass(frozen=True)
class AppendTable:
    """Appends source rows above the highest ``watermark_column`` value loaded.

    ``keys`` identify a row of the source. With them, rows that share the highest value,
    arrive up to ``overlap`` below it (seconds for times, else in units of the column), or have
    no value there, are taken too, each once. Without them rows with no value are set aside.
    ``cluster`` names number, date or time columns along which the rows of a load are ordered.
    """

    table: str
    watermark_column: str
    where: str | None = None
    keys: tuple[str, ...] = ()
    overlap: float | None = None
    cluster: tuple[str, ...] = ()
    kind: str = field(default="append", init=False)

    def __post_init__(self):
        _set(
            self,
            table=_name("table", self.table),
            watermark_column=_name("watermark_column", self.watermark_column),
            keys=_columns("keys", self.keys),
            cluster=_columns("cluster", self.cluster),
        )
        if self.overlap is not None and (self.overlap <= 0 or not self.keys):
            raise ValueError("overlap must be positive and needs keys")


TableConfig = PartitionTable | Scd2Table | StaticTable | AppendTable

_KINDS = {
    "static": StaticTable,
    "scd": Scd2Table,
    "partition": PartitionTable,
    "append": AppendTable,
}


def table_from_mapping(entry: Mapping) -> TableConfig:
    """Build a description from a plain mapping with a ``kind`` entry."""
    values = dict(entry)
    kind = values.pop("kind", None)
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {sorted(_KINDS)}, not {kind!r}")
    known = {f.name for f in fields(_KINDS[kind]) if f.init}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown settings for a {kind} table: {unknown}")
    for key in ("keys", "primary_keys", "tracked", "tie_break", "cluster"):
        if isinstance(values.get(key), list):
            values[key] = tuple(values[key])
    return _KINDS[kind](**values)


def select_tables(
    tables: Iterable[TableConfig],
    kinds: Iterable[str] | None = None,
    names: Iterable[str] | None = None,
) -> list[TableConfig]:
    """Tables to run, reference tables first, then dimensions, then facts."""
    tables = list(tables)
    seen = [t.table for t in tables]
    twice = sorted({n for n in seen if seen.count(n) > 1})
    if twice:
        raise ValueError(f"tables described more than once: {twice}")
    kinds = set(kinds) if kinds is not None else set(_KINDS)
    if kinds - set(_KINDS):
        raise ValueError(f"unknown kinds: {sorted(kinds - set(_KINDS))}")
    wanted = set(names) if names is not None else None
    if wanted is not None and wanted - set(seen):
        raise ValueError(f"no such tables: {sorted(wanted - set(seen))}")
    rank = list(_KINDS)
    chosen = [t for t in tables if t.kind in kinds and (wanted is None or t.table in wanted)]
    return sorted(chosen, key=lambda t: rank.index(t.kind))
