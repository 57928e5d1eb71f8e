"""CSV records with quoted line breaks from files that are split like any text.

A quote inside a quoted field is doubled, so a line starts inside a quoted
field exactly if an odd number of quotes stands before it.  The quotes of every
split are counted first; their running parity over a file's splits tells for
each split how its first line starts.  Then every split joins its own lines to
records.  Only the records that cross a border of splits are put together by a
shuffle: at most an ending and a beginning per split.

Lines end with \\n or \\r\\n, as in a read with multi-line fields.  A quote that
stands inside an unquoted field is not supported (it has no partner to count).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, ENDING, BEGINNING = 0, 1, 2


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file and block (where the split starts) of every line, in file order within a partition."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"))


def inside_at_start(text: DataFrame) -> DataFrame:
    """file and block of the splits that start inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    per_split = text.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return per_split.select("file", "block", (F.sum("quotes").over(before) % 2 == 1).alias("inside")).where("inside")


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the splits that arrive line by line: file, block, kind, first (of its file) and record."""
    split, held, odd, kind, first = None, [], 0, WHOLE, False
    for batch in batches:
        out = []

        def emit(what: int) -> None:
            nonlocal first
            out.append((*split, what, first, "\n".join(held)))
            held.clear()
            first = False

        values = batch["value"].to_pylist()
        quotes = pc.count_substring(batch["value"], '"').to_numpy(zero_copy_only=False)
        names, starts, inside = batch["file"].to_pylist(), batch["block"].to_pylist(), batch["inside"].to_pylist()
        for value, n, file, block, within in zip(values, quotes.tolist(), names, starts, inside):
            if (file, block) != split:
                if held:
                    emit(ENDING if kind == ENDING else BEGINNING)
                split, odd, kind, first = (file, block), int(bool(within)), ENDING if within else WHOLE, block == 0
            held.append(value)
            odd = (odd + n) % 2
            if not odd:
                emit(kind)
                kind = WHOLE
        if out:
            yield _batch(out)
    if held:
        yield _batch([(*split, ENDING if kind == ENDING else BEGINNING, first, "\n".join(held))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], [n for n, _ in kinds])


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files behind their first (the header): the column record, line breaks as \\n, no empty records.

    The splits that start inside a field are broadcast: one row each at most, and the driver holds the list of all splits anyway.
    """
    text = lines(spark, path)
    known = text.join(F.broadcast(inside_at_start(text)), ["file", "block"], "left").select("value", "file", "block", "inside")
    found = known.mapInArrow(_join_lines, "file string, block long, kind int, first boolean, record string")
    whole = found.where(F.col("kind") == WHOLE).select("first", "record")
    parts = found.where(F.col("kind") != WHOLE)
    # an ending belongs to the last beginning before it
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.last(F.when(F.col("kind") == BEGINNING, F.col("block")), ignorenulls=True).over(order)
    glued = (
        parts.withColumn("start", start)
        .groupBy("file", "start")
        .agg(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("x"), F.max("first").alias("first"))
        # the beginning's own split may also hold the ending of the record before, which sorts first
        .select("first", F.array_join(F.transform("x", lambda p: p["record"]), "\n").alias("record"))
    )
    # a file whose lines end with \r\n has them as \n inside its fields
    unix = F.replace(F.substring("record", F.lit(1), F.length("record") - 1), F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.endswith(F.col("record"), F.lit("\r")), unix).otherwise(F.col("record")).alias("record")
    return whole.unionByName(glued).where(~F.col("first")).select(text).where(F.col("record") != "")


def read(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The records as text columns, named in the order of the header."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    return records(spark, path).select(F.from_csv("record", schema, options).alias("r")).select("r.*")
