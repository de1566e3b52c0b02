"""Incremental table synchronisation on Spark DataFrames."""

from tidemark.config import AppendTable, PartitionTable, Scd2Table, StaticTable

__all__ = ["AppendTable", "PartitionTable", "Scd2Table", "StaticTable"]
