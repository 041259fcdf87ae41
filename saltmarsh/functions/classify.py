"""Ordered level classes of a height, by the quartiles of the batch or by fixed thresholds.

Null, NaN and infinite heights have the class ``""``; infinite ones still count in the quartiles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.sources.tables import materialize

#: The four labels, lowest first.
LABELS = ("低潮", "中低潮", "中高潮", "高潮")
#: Upper bounds of the first three labels; the last bound is exclusive.
THRESHOLDS = (-1.0, 0.0, 0.6)


def finite(h: Column) -> Column:
    return h.isNotNull() & ~F.isnan(h) & (F.abs(h) != float("inf"))


#: A sketch of n values is off by n * RANK_ERROR ranks at most.
RANK_ERROR = 1 / 10_000
#: Values that are no longer narrowed down, but fetched.
FEW_VALUES = 20_000


@dataclass
class _Sought:
    """The value at a rank (from 0): it lies between low and high, ends left out, with ``below`` values up to low."""

    rank: int
    inside: int
    below: int
    low: float = -math.inf
    high: float = math.inf
    value: float | None = None

    def place(self, v: Column) -> Column:
        out = F.lit(True)
        if self.low > -math.inf:
            out = out & (v > self.low)
        if self.high < math.inf:
            out = out & (v < self.high)
        return out

    def narrow(self, a: float, b: float, counts: tuple[int, int, int, int]) -> None:
        """Take the part that holds the rank, by how many values are below a, a, between a and b, and b."""
        rank = self.rank - self.below
        for part, n in enumerate(counts):
            if rank < n:
                if part in (1, 3):
                    self.value = a if part == 1 else b
                else:
                    self.low, self.high = (self.low, a) if part == 0 else (a, b)
                    self.below, self.inside = self.rank - rank, n
                return
            rank -= n
        self.low, self.below, self.inside = b, self.rank - rank, self.inside - sum(counts)


def values_at(values: DataFrame, ranks: list[int], n: int, low: int, high: int) -> dict[int, float]:
    """The values of the finite column ``v`` at these ranks, ``low`` and ``high`` being values of minus and plus infinity beside them.

    Selection by rounds: a mergeable sketch of what lies in the bracket of each rank gives two values around it, one pass
    counts what is below, at and between them, and the bracket becomes the part that holds the rank. A round leaves some
    6 / 10,000 of the values, so 10 ** 12 take three; those left are stored, so only the first round reads all. Values that
    many rows share are counted as an end of a bracket and never lie in it. Brackets of FEW_VALUES rows are fetched. So
    no task sorts or holds more than a sketch or FEW_VALUES rows for each rank.
    """
    out = {r: -math.inf if r < low else math.inf for r in ranks if r < low or r >= n - high}
    left = [_Sought(r, n - low - high, low) for r in ranks if r not in out]
    v, known = F.col("v"), left
    while left := [s for s in left if s.value is None and s.inside > FEW_VALUES]:
        at = [((s.rank - s.below) / s.inside, s.place(v)) for s in left]
        ends = [F.array(*(F.lit(min(1.0, max(0.0, p + side * 3 * RANK_ERROR))) for side in (-1, 1))) for p, _ in at]
        sketch = values.agg(*(F.percentile_approx(F.when(here, v), e, F.lit(round(1 / RANK_ERROR))).alias(f"s{k}") for k, ((_, here), e) in enumerate(zip(at, ends, strict=True)))).first()
        pairs = [(sketch[k][0], sketch[k][1]) for k in range(len(left))]
        tests = [here & t for (a, b), (_, here) in zip(pairs, at, strict=True) for t in (v < a, v == a, (v > a) & (v < b), (v == b) & F.lit(a != b))]
        counts = values.agg(*(F.count_if(t).alias(f"n{k}") for k, t in enumerate(tests))).first()
        for k, (s, (a, b)) in enumerate(zip(left, pairs, strict=True)):
            s.narrow(a, b, tuple(counts[4 * k : 4 * k + 4]))
        open_ = [s.place(v) for s in known if s.value is None]
        if open_:
            values = materialize(values.where(reduce(or_, open_)), "bracket")
    rest = [s for s in known if s.value is None]
    if rest:
        # FEW_VALUES for each rank at most
        by_value = values.where(reduce(or_, [s.place(v) for s in rest])).groupBy("v").count().collect()
        for s in rest:
            upto = s.below
            for x, times in sorted((r["v"], r["count"]) for r in by_value if s.low < r["v"] < s.high):
                upto += times
                if upto > s.rank:
                    s.value = x
                    break
    return out | {s.rank: s.value for s in known}


def quantile_cuts(df: DataFrame, height: str) -> DataFrame:
    """One row with q25, q50 and q75, exact and interpolated linearly, NaN left out; nulls without values.

    ``df`` is read three times or, with very many values, some more, so heights that cost much should be stored. Between
    values that differ and of which one is infinite a quartile is that one, or plus infinity between both.
    """
    spark, h = df.sparkSession, F.col(height).cast("double")
    values = df.select(F.nanvl(h, F.lit(None).cast("double")).alias("v")).where("v IS NOT NULL")
    v = F.col("v")
    n, low, high = values.agg(F.count("v"), F.count_if(v == -math.inf), F.count_if(v == math.inf)).first()
    at = {q: share * (n - 1) for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))} if n else {}
    ranks = sorted({f(x) for x in at.values() for f in (math.floor, math.ceil)})
    found = values_at(values.where(F.abs(v) != math.inf), ranks, n, low, high) if ranks else {}

    def cut(x: float) -> float:
        a, b, part = found[math.floor(x)], found[math.ceil(x)], x - math.floor(x)
        if a == b or math.isinf(a) and math.isinf(b):
            return b
        return a if math.isinf(a) else b if math.isinf(b) else (1 - part) * a + part * b

    row = tuple(cut(at[q]) if q in at else None for q in ("q25", "q50", "q75"))
    return spark.createDataFrame([row], "q25 double, q50 double, q75 double")


def _labelled(h: Column, bounds: list[Column]) -> Column:
    out = F.when(~F.coalesce(finite(h), F.lit(False)), "")
    for bound, label in zip(bounds, LABELS, strict=False):
        out = out.when(bound, label)
    return out.otherwise(LABELS[3])


def quantile_class(h: Column, q25: Column, q50: Column, q75: Column) -> Column:
    return _labelled(h, [h <= q25, h <= q50, h <= q75])


def threshold_class(h: Column) -> Column:
    low, middle, high = THRESHOLDS
    return _labelled(h, [h <= low, h <= middle, h < high])


def with_classes(df: DataFrame, height: str) -> DataFrame:
    """Add q25, q50, q75, tide_level_class and tide_level_class_threshold; the cuts are one broadcast row. See ``quantile_cuts`` on costly heights."""
    h = F.col(height)
    return (
        df.crossJoin(F.broadcast(quantile_cuts(df, height)))
        .withColumn("tide_level_class", quantile_class(h, F.col("q25"), F.col("q50"), F.col("q75")))
        .withColumn("tide_level_class_threshold", threshold_class(h))
    )
