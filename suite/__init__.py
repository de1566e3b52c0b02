"""The registered queries: each operator on the given tables, with its SQL twin."""

from suite import partitions, reports, scd2, static, types
from suite.base import Case

ALL_CASES: dict[str, Case] = {
    **partitions.CASES,
    **scd2.CASES,
    **static.CASES,
    **types.CASES,
    **reports.CASES,
}
