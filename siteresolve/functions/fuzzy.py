"""Token-set similarity of names: word sets compared by the longest common subsequence of their characters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits per character of ``b``: a zero at place k says that the row grows there."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    all_ones = (1 << len(a)) - 1
    row = all_ones
    for c in b:
        held = row & at.get(c, 0)
        row = (row + held | row - held) & all_ones
    return len(a) - row.bit_count()


def _ratio(distance: int, length: int) -> float:
    return 100.0 - 100.0 * distance / length if length else 100.0


def token_set_ratio(a: str | None, b: str | None) -> float:
    """0 to 100: the best of three comparisons of the shared words, and these with the words that only one side has, each list in order; 100 if one side has no words of its own.

    Two lists differ by the characters that are in one only (Indel distance: both lengths less twice the common subsequence). Nulls and texts without words give 0.
    """
    left, right = set((a or "").split()), set((b or "").split())
    if not left or not right:
        return 0.0
    shared = left & right
    if shared and (left == shared or right == shared):
        return 100.0
    one, other = " ".join(sorted(left - shared)), " ".join(sorted(right - shared))
    n = len(" ".join(sorted(shared)))
    gap = 1 if n else 0
    distance = len(one) + len(other) - 2 * common_subsequence(one, other)
    best = _ratio(distance, 2 * (n + gap) + len(one) + len(other))
    if n:
        best = max(best, _ratio(gap + len(one), 2 * n + gap + len(one)), _ratio(gap + len(other), 2 * n + gap + len(other)))
    return best


@F.pandas_udf(DoubleType())
def _token_set(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(a, b):
        if pair not in known:
            known[pair] = token_set_ratio(*pair)
        out.append(known[pair])
    return pd.Series(out)


def token_set(a: Column, b: Column) -> Column:
    """``similarity`` of two normalized texts by token sets: 0 if one is blank, 100 if one contains the other, else ``token_set_ratio``.

    The Arrow function compares each distinct pair of a batch once; pairs that the first two rules decide reach it as nulls. No pair is shuffled.
    """
    plain = (a == "") | (b == "")
    within = a.contains(b) | b.contains(a)
    open_ = ~(plain | within)
    return F.when(plain, F.lit(0.0)).when(within, F.lit(100.0)).otherwise(_token_set(F.when(open_, a), F.when(open_, b)))
