"""Digests of the rows of a table that do not depend on their order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOW24 = 0xFFFFFF


def rows_checksum(columns: list[Column]) -> Column:
    """Aggregate: rows, exclusive or and two sums of their hashes as text.

    The sums tell tables apart whose rows come several times, as equal rows cancel each other in
    an exclusive or. They take 24 bits of a hash each, so they hold 2**39 rows without overflow.
    """
    row = F.xxhash64(*columns)
    low = row.bitwiseAND(F.lit(LOW24).cast("bigint"))
    parts = [F.count(F.lit(1)), F.bit_xor(row), F.sum(F.shiftright(row, 40)), F.sum(low)]
    return F.concat_ws("-", *(F.hex(F.coalesce(part, F.lit(0).cast("bigint"))) for part in parts))
