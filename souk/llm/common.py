"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.session import ensure_checkpoint_dir

# The white space of the contracts, and the ASCII capitals.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  lower() does just that to pure ASCII; other text needs translate()."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def union_columns(df: DataFrame, *names: str) -> list[str]:
    """The columns of df but for names (in any case of letters)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared checkpoint folder and read back: cuts the lineage of large tables, compressed."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Up to so many rows a table is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 10_000


def small(df: DataFrame) -> DataFrame:
    """A checkpointed table, marked for broadcasting if a count shows that it is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
