"""Raw CSV extraction with the declared schema.

Every column is read as text, matched to the declared columns by its header
name, so the missing-value words of the original reader (``NA``, ``N/A``,
``null``, empty, ...) become NULL in any column; then it is cast to its
declared type.  Quoted fields may span lines and
escape quotes by doubling them.  Derived columns are not expected in the
files.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.exprs import na_to_null
from souk.sources import quoted_csv
from souk.sources.schemas import LOAD_ORDER, TABLES


class MissingSourceError(FileNotFoundError):
    """A raw directory or file is missing."""


def _is_missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (exc.getCondition() or "") or "PATH_NOT_FOUND" in str(exc)


def read_csv_table(spark: SparkSession, table: str, raw_dir: str, path: str | None = None) -> DataFrame:
    """One raw table with its declared types.

    The table is the file ``raw_dir/<raw file>``, or a folder of that name
    holding part files, or whatever ``path`` says (a glob, too).  All files
    are split like any text; those of a table with free text, whose quoted
    fields may hold line breaks, are cut into records by counting quotes.
    """
    spec = TABLES[table]
    path = path or f"{raw_dir.rstrip('/')}/{spec.raw_file}"
    cols = [c for c, _, _ in spec.columns if c not in spec.derived]
    # no schema and no inference: every column is text, named by the header,
    # so columns are matched by name (a declared schema would match by position)
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        # keep the text as written: NA words and blanks are handled below
        .option("nullValue", None)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    try:
        raw = reader.csv(path)  # the path is resolved (and checked) here
    except AnalysisException as exc:
        if _is_missing(exc):
            raise MissingSourceError(f"missing raw data file for '{table}': {path}") from exc
        raise
    if spec.free_text:
        raw = quoted_csv.read(spark, path, raw.columns)
    missing = [c for c in cols if c not in raw.columns]
    if missing:
        raise ValueError(f"raw file for '{table}' lacks columns {missing}: {path}")
    types = {c: t for c, t, _ in spec.columns}
    out = []
    for c in cols:
        v = na_to_null(c)
        t = types[c]
        if isinstance(t, T.StringType):
            out.append(v.alias(c))
        elif isinstance(t, T.IntegerType):
            # whole numbers may be written as 3.0 by float-typed exports
            out.append(F.round(F.trim(v).cast("double"), 0).cast("int").alias(c))
        else:
            out.append(F.trim(v).cast(t).alias(c))
    return raw.select(*out)


def extract_all(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """S2 + S3: all nine raw tables; a missing directory or file raises MissingSourceError."""
    if "://" not in raw_dir and not os.path.isdir(raw_dir):
        raise MissingSourceError(f"raw data directory not found: {raw_dir}")
    return {t: read_csv_table(spark, t, raw_dir) for t in LOAD_ORDER}
