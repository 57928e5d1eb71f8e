"""Shares of a grand total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_grand_totals(grouped: DataFrame, totals: dict[str, str]) -> DataFrame:
    """Add, to every row of an aggregated result, the sum of some of its columns
    over all rows (``totals`` maps output name -> column).

    ``grouped`` must be a group-by result over a small closed domain (payment
    type, instalment count, delivery status): the window without partition key
    then sees one row per group, never the base table, and the base table is
    scanned once (a self-join with a separate total would read it twice, since
    the two branches prune to different aggregates).
    """
    everything = Window.partitionBy()
    return grouped.select("*", *[F.sum(c).over(everything).alias(name) for name, c in totals.items()])
