"""Expressions that several SQL twins need."""

from __future__ import annotations


def crc32(text: str) -> str:
    """crc32 of an ASCII text as an unsigned number, bit by bit."""
    bits = (
        f"list_transform(range(8 * length({text})), lambda i: "
        f"CASE WHEN i % 8 = 0 THEN ascii(substr({text}, (i // 8 + 1)::INT, 1))::BIGINT ELSE 0::BIGINT END)"
    )
    step = "lambda x, b: xor(xor(x, b) >> 1, 3988292384::BIGINT * (xor(x, b) & 1))"
    return f"xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"
