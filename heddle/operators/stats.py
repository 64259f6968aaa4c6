"""Table statistics: row count and a random sample."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PAGE = 200


@dataclass
class Statistics:
    rows: int
    pages: int
    sample: DataFrame


def analyze(df: DataFrame, sample: int, seed: int = 0) -> Statistics:
    """Counts the rows and draws about `sample` of them, never more; the same seed draws the same rows of the same files.

    Of what is drawn beyond `sample` the rows of the greatest random numbers go, wherever they lie.
    """
    rows = df.count()
    fraction = min(1.0, 1.2 * sample / rows + 10 / rows) if rows else 1.0
    drawn = df if fraction >= 1 else df.sample(fraction=fraction, seed=seed)
    return Statistics(rows, max(1, -(-rows // ROWS_PER_PAGE)), drawn.orderBy(F.rand(seed + 1)).limit(sample))
