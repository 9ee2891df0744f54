"""Seeded, order-free random draws as column expressions.

Each draw is the first 15 hex digits of ``md5("seed|table|column|key")`` read
as an unsigned 60-bit integer, so that a remainder picks evenly among any
number of rows a table can hold. It depends only on its inputs, so a recomputed
task (lost executor, speculative copy) produces the same rows, the result
does not depend on partitioning, and an SQL engine with ``md5`` can reproduce
every value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_DIGITS = 15
DRAW_RANGE = 1 << (4 * DRAW_DIGITS)


def draw(seed: int | str, table: str, column: str, key: Column) -> Column:
    """Unsigned 60-bit draw for ``key`` (BIGINT in [0, 2^60))."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(table), F.lit(column), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("long")


def choice(values: Sequence[object], h: Column) -> Column:
    """Pick one of ``values`` (``None`` allowed) evenly by draw ``h``."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (h % len(values) + 1).cast("int"))


def between(lo: int, hi: int, h: Column) -> Column:
    """Integer in [lo, hi] (inclusive) by draw ``h``."""
    return F.lit(lo) + h % (hi - lo + 1)


def letters(number: Column, width: int) -> Column:
    """Base-26 spelling of ``number`` with ``width`` capital letters."""
    chars = []
    for j in range(width - 1, -1, -1):
        digit = F.floor(number / F.lit(26**j)).cast("long") % 26
        chars.append(F.char(digit + 65))
    return F.concat(*chars)
