"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position"


def newest_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], where: Column | None = None
) -> DataFrame:
    """The first row of each key in the given order.

    Spark cuts every map partition down to one row per key before the shuffle (WindowGroupLimit), so
    a key that owns a large share of the rows sends one row per map task, not its rows. ``where`` is
    tested on the winners, in the same step.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    winner = F.col(_POSITION) == 1
    ranked = df.withColumn(_POSITION, position)
    return ranked.filter(winner if where is None else winner & where).drop(_POSITION)
