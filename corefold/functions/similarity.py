"""String similarity. Set measures are JVM expressions; the family on longest common subsequences is an Arrow kernel over distinct pairs."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct n-grams; a shorter text is its only one, an empty text has none."""
    length = F.char_length(c)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n)))
    return F.when(length == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / union).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """The larger share of either set that the other has; 0 if either is empty."""
    a, b = F.array_distinct(a), F.array_distinct(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.greatest(shared / F.size(a), shared / F.size(b))).otherwise(F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


# Longest common subsequences by bit-parallel arithmetic on Python's integers (Hyyrö's recurrence).


@lru_cache(maxsize=65536)
def _masks(a: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(a):
        out[c] = out.get(c, 0) | 1 << i
    return out


def lcs(a: str, b: str) -> int:
    """Length of a longest common subsequence."""
    if not a or not b:
        return 0
    masks, full = _masks(a), (1 << len(a)) - 1
    s = full
    for c in b:
        m = masks.get(c)
        if m is not None:
            u = s & m
            s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    """2 * LCS / total length, 0 to 1; 1 for two empty texts."""
    total = len(a) + len(b)
    return 1.0 if not total else 2 * lcs(a, b) / total


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text with a window of the longer, windows that the ends cut included; both ways for equal lengths."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    best = _windows(a, b)
    return max(best, _windows(b, a)) if len(a) == len(b) and best < 1 else best


def _windows(a: str, b: str) -> float:
    n, chars, best = len(a), set(a), 0.0
    for end in range(1, len(b) + n):
        lo, hi = max(0, end - n), min(end, len(b))
        # A window that starts or ends with a character that the shorter text lacks is no better than its neighbour.
        if (b[hi - 1] in chars if hi == end else b[lo] in chars) and 2 * min(n, hi - lo) / (n + hi - lo) > best:
            best = max(best, ratio(a, b[lo:hi]))
            if best == 1:
                break
    return best


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """0 if either has no token; 1 if the shared tokens are all of one side's; else the best ratio among shared, shared with a's and shared with b's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_x or not only_y):
        return 1.0
    left, right, shared = " ".join(only_x), " ".join(only_y), " ".join(both)
    gap = 1 if both else 0
    n_shared = len(shared)
    n_left, n_right = n_shared + gap + len(left), n_shared + gap + len(right)
    # The shared part is a common prefix, so it counts as a whole.
    best = 2 * (n_shared + gap + lcs(left, right)) / (n_left + n_right) if n_left + n_right else 0.0
    if both:
        best = max(best, 2 * n_shared / (n_shared + n_left), 2 * n_shared / (n_shared + n_right))
    return best


KERNELS = {"ratio": ratio, "partial_ratio": partial_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio}


def _udf(kernel):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a, b):
            if pair[0] is None or pair[1] is None:
                out.append(None)
                continue
            got = known.get(pair)
            if got is None:
                got = known[pair] = kernel(*pair)
            out.append(got)
        return pd.Series(out, dtype="float64")

    return run


_UDFS = {name: _udf(kernel) for name, kernel in KERNELS.items()}


def similarity(kind: str, a: Column, b: Column) -> Column:
    """One of ``KERNELS``, 0 to 1; null if either text is."""
    return _UDFS[kind](a, b)


def lcs_sql(a: str, b: str) -> str:
    """The length of a longest common subsequence as a SQL expression of two columns: slow, but plain; a cross-check of the kernel."""
    row = f"transform(sequence(1, greatest(char_length({b}), 1)), j -> 0)"
    step = (
        f"(row, i) -> aggregate(sequence(1, char_length({b})), named_struct('out', cast(array() as array<int>), 'left', 0, 'diag', 0), "
        f"(s, j) -> named_struct('out', concat(s.out, array(if(substring({a}, i, 1) = substring({b}, j, 1), s.diag + 1, greatest(s.left, row[j - 1])))), "
        f"'left', if(substring({a}, i, 1) = substring({b}, j, 1), s.diag + 1, greatest(s.left, row[j - 1])), 'diag', row[j - 1])).out"
    )
    return f"CASE WHEN char_length({a}) = 0 OR char_length({b}) = 0 THEN 0 ELSE element_at(aggregate(sequence(1, char_length({a})), {row}, {step}), -1) END"


def with_similarities(df: DataFrame, pairs: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Add columns ``name: (kind, left column, right column)``, all in one pass over Arrow batches."""
    return df.withColumns({name: similarity(kind, F.col(a), F.col(b)) for name, (kind, a, b) in pairs.items()})


def register(spark: SparkSession) -> None:
    """The kernels as SQL functions: ``indel_ratio``, ``partial_ratio``, ``token_sort_ratio``, ``token_set_ratio``, ``nfc``."""
    from .text import _nfc

    for name, udf in _UDFS.items():
        spark.udf.register("indel_ratio" if name == "ratio" else name, udf)
    spark.udf.register("nfc", _nfc)
