"""Functions that the oracles need and DuckDB lacks, written in its SQL."""

from __future__ import annotations


def _nibbles() -> list[int]:
    """CRC-32 of each half byte."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    halves = f"flatten([[ord(c) & 15, ord(c) >> 4] FOR c IN string_split({text}, '')])"
    step = f"xor(crc >> 4, {_nibbles()}[((xor(crc, b)) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}::BIGINT[]), lambda crc, b: {step}), 4294967295::BIGINT)"
