"""Confidences that mean what they say: reliability by bin, and isotonic calibration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_of(score: Column, width: float, bins: int) -> Column:
    """Bins of equal width from 0 on; the last is open, a null score has none."""
    place = F.least(F.greatest(F.floor(score / F.lit(width)), F.lit(0).cast("long")), F.lit(bins - 1).cast("long"))
    return F.when(score.isNotNull(), place)


def reliability(df: DataFrame, score: str, correct: Column, width: float, bins: int) -> DataFrame:
    """(bin, rows, correct, mean_score, accuracy) of each bin in use: at most `bins` rows, whatever the data."""
    rows = df.filter(F.col(score).isNotNull() & correct.isNotNull())
    by_bin = rows.groupBy(bin_of(F.col(score), width, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(correct).alias("correct"), F.avg(score).alias("mean_score")
    )
    return by_bin.withColumn("accuracy", F.col("correct") / F.col("rows"))


@dataclass
class Calibration:
    """A share of right answers for every bin, never falling from one bin to the next."""

    width: float
    shares: list[float]

    def apply(self, score: Column) -> Column:
        """The calibrated confidence of a score; null for a null score."""
        place = bin_of(score, self.width, len(self.shares)).cast("int")
        return F.get(F.array(*[F.lit(x) for x in self.shares]), place)


def pooled(rows: Sequence[int], right: Sequence[int]) -> list[float]:
    """Pool adjacent violators: the closest never-falling shares, by least squares weighted by rows.

    A bin without rows takes the value of the one below it, or of the first in use.
    """
    blocks: list[list[int]] = []  # rows, right, bins
    for n, r in zip(rows, right):
        blocks.append([n, r, 1])
        while len(blocks) > 1 and _falls(blocks[-2], blocks[-1]):
            n, r, bins = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + r, blocks[-1][2] + bins]
    out = [x for n, r, bins in blocks for x in [r / n if n else None] * bins]
    first = next((x for x in out if x is not None), 0.0)
    for i, x in enumerate(out):
        out[i] = (out[i - 1] if i else first) if x is None else x
    return out


def _falls(low: list[int], high: list[int]) -> bool:
    """Whole numbers decide, so a tie is a tie; an empty block joins the one below it."""
    return high[0] == 0 or (low[0] > 0 and low[1] * high[0] >= high[1] * low[0])


def fit_isotonic(df: DataFrame, score: str, correct: Column, width: float, bins: int) -> Calibration:
    """Calibrate on rows whose right answer is known; the driver sees a row per bin."""
    found = {r["bin"]: (r["rows"], r["correct"]) for r in reliability(df, score, correct, width, bins).collect()}
    counts = [found.get(b, (0, 0)) for b in range(bins)]
    return Calibration(width, pooled([n for n, _ in counts], [r for _, r in counts]))


def to_relabel(df: DataFrame, calibration: Calibration, score: str, lo: float = 0.4, hi: float = 0.6, out: str = "confidence") -> DataFrame:
    """Rows whose calibrated confidence is from `lo` to `hi`, for a person to label."""
    return df.withColumn(out, calibration.apply(F.col(score))).filter(F.col(out).between(lo, hi))
