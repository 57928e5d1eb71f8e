"""The warehouse: nine clean tables as DataFrames, from the driver tables or
from parquet files written by the load step."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.jobs import run_concurrently
from souk.operators.clean import ORDER_KEYED, transform_all
from souk.sources.driver import raw_tables
from souk.sources.schemas import LOAD_ORDER, TABLES


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table as declared — columns selected by name in DDL order and
    cast to their declared types (missing columns are an error, extra ones
    are dropped).  Integer-typed id columns (``*_id``) are kept as integers:
    the builders join on them whatever their type, and integers are cheaper
    to hash and shuffle than text.
    """
    spec = TABLES[table]
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in spec.column_names if c not in have]
    if missing:
        raise ValueError(f"table '{table}' lacks columns {missing}")
    out = []
    for c, t, _ in spec.columns:
        keep = c.endswith("_id") and isinstance(have[c], T.IntegralType) and isinstance(t, T.StringType)
        out.append(F.col(c) if keep or have[c] == t else F.col(c).cast(t).alias(c))
    return df.select(*out)


def conform_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: conform(df, name) for name, df in tables.items()}


def from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Clean warehouse tables derived lazily from the driver's parquet tables.

    The full cleaning step runs: trim, exact dedupe, translation, derived columns.
    """
    return transform_all(raw_tables(spark, sf_dir))


def write_tables(tables: dict[str, DataFrame], root: str, parallelism: int = 4) -> None:
    """(re)create each table as parquet under root/<table>, replacing old files.

    The nine writes are independent jobs, submitted concurrently.
    """
    def write(name: str) -> None:
        tables[name].write.mode("overwrite").parquet(f"{root}/{name}")

    run_concurrently([lambda n=n: write(n) for n in LOAD_ORDER], parallelism)


#: The file of a warehouse folder that names its current version, and behind it the one before.
MANIFEST = "MANIFEST"


def _file_system(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def write_text(spark: SparkSession, file: str, text: str) -> None:
    """Write a small file, replacing an older one."""
    fs, path = _file_system(spark, file)
    out = fs.create(path(file), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_lines(spark: SparkSession, file: str, most: int) -> list[str]:
    """The first lines of a small file; none if there is no such file."""
    fs, path = _file_system(spark, file)
    return [r["value"] for r in spark.read.text(file).limit(most).collect()] if fs.exists(path(file)) else []


def remove(spark: SparkSession, file: str) -> None:
    fs, path = _file_system(spark, file)
    fs.delete(path(file), False)


def versions(spark: SparkSession, root: str) -> list[str]:
    """The current version of a warehouse folder and the one before it; empty without a manifest."""
    return read_lines(spark, f"{root}/{MANIFEST}", 2)


def new_version() -> str:
    return f"version-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make root/<version> what readers see, in one rename of the manifest.

    Whatever fails before the rename leaves the old version as it was; the version before it stays for readers that
    opened it, the one before that goes.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, path = _file_system(spark, root)
    old = versions(spark, root)
    written = path(f"{root}/{version}.manifest")
    write_text(spark, f"{root}/{version}.manifest", "".join(f"{v}\n" for v in [version, *old[:1]]))
    over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(written), fs.makeQualified(path(f"{root}/{MANIFEST}")), over)
    for gone in old[1:]:
        fs.delete(path(f"{root}/{gone}"), True)


def discard(spark: SparkSession, root: str, version: str) -> None:
    """Remove a version that was not published."""
    fs, path = _file_system(spark, root)
    fs.delete(path(f"{root}/{version}"), True)


def read_tables(spark: SparkSession, root: str, version: str | None = None) -> dict[str, DataFrame]:
    """Open a warehouse: its current version by the manifest, a given version, or plain tables without a manifest."""
    version = version or next(iter(versions(spark, root)), None)
    at = f"{root}/{version}" if version else root
    return {name: spark.read.parquet(f"{at}/{name}") for name in LOAD_ORDER}


def save_catalog_tables(
    tables: dict[str, DataFrame],
    database: str,
    buckets: int | None,
    parallelism: int = 4,
    prepartitioned: bool = False,
) -> None:
    """S4/S5 as catalog tables: the four order-keyed tables are bucketed (and
    sorted) by order_id into the same number of buckets, so per-order
    aggregates and order-to-order joins read co-partitioned data and need no
    shuffle.  Each bucket is written by one task (the data is hash
    partitioned by the bucket key into ``buckets`` partitions first, here or
    — ``prepartitioned=True`` — by ``transform_all(order_partitions=...)``),
    giving one file per bucket.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def write(name: str) -> None:
        df = tables[name]
        if buckets and name in ORDER_KEYED:
            if not prepartitioned:
                df = df.repartition(buckets, "order_id")
            (
                df.write.mode("overwrite")
                .format("parquet")
                .bucketBy(buckets, "order_id")
                .sortBy("order_id")
                .saveAsTable(f"{database}.{name}")
            )
        else:
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")

    run_concurrently([lambda n=n: write(n) for n in LOAD_ORDER], parallelism)


#: The properties of a database that name the databases of its current version and of the one before.
CURRENT, PREVIOUS = "souk.current", "souk.previous"


def _properties(spark: SparkSession, database: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").collect()
    text = next((r[1] for r in rows if r[0] == "Properties"), "")
    return dict(re.findall(r"\((souk\.\w+),\s*(\w+)\)", text))


def publish_catalog(spark: SparkSession, database: str, version: str) -> None:
    """Make the tables of the database `version` those of `database`, by one change of its properties; the last but one version goes."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    old = _properties(spark, database)
    before = old.get(CURRENT, version)
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{CURRENT}' = '{version}', '{PREVIOUS}' = '{before}')")
    gone = old.get(PREVIOUS)
    if gone and gone not in (version, before):
        spark.sql(f"DROP DATABASE IF EXISTS {gone} CASCADE")


def current_database(spark: SparkSession, database: str) -> str:
    """The database that holds the tables of the current version; the database itself if none was published."""
    return _properties(spark, database).get(CURRENT, database)


def read_catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The warehouse as catalog tables (bucketing metadata included), by the database's current version."""
    current = current_database(spark, database)
    return {name: spark.table(f"{current}.{name}") for name in LOAD_ORDER}
