"""Line dedup: drop the lines that many documents share, without moving text.

Method: every line becomes a 128-bit hash of its normalised form.  The
hashes are pre-aggregated (one row per key and document, then one row per key
and salt, so that a line found in a third of all documents is a few rows),
range-partitioned with a secondary sort by document and position, and streamed
by a window that runs in that order: the first row of a key is its first
occurrence and carries its number of documents.  What comes back to a document
is not text but a compressed keep bitmap: the runs of dropped line numbers.

Defined results: a null or empty text is one empty line; empty keys (blank
lines) are never dropped; every row is a document of its own, also one that
equals another (equal rows are told apart by their number alone and get equal
results), a null doc_id is an id like any other; every input row has its row in the result; an empty table gives an empty result; other columns are carried along untouched
by ``drop_lines`` whatever their names (names starting ``__ld_`` are reserved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import WHITE, ascii_lower, partitions, small
from souk.session import reliable_checkpoint

SALTS = 32


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def line_hashes(docs: DataFrame) -> DataFrame:
    """One row per non-blank line: document (id and text hash), position, 128-bit key hash."""
    d = docs.select(F.col("doc_id").alias("__ld_id"), F.xxhash64("text").alias("__ld_th"), _lines(F.col("text")).alias("__ld_ls"))
    d = d.select("__ld_id", "__ld_th", F.posexplode("__ld_ls").alias("__ld_pos", "__ld_line"))
    d = d.select("__ld_id", "__ld_th", "__ld_pos", line_key(F.col("__ld_line")).alias("__ld_key"))
    return d.where(F.col("__ld_key") != "").select(
        "__ld_id", "__ld_th", "__ld_pos", F.xxhash64("__ld_key").alias("h1"), F.xxhash64(F.lit("line"), "__ld_key").alias("h2")
    )


def repeated_rows(docs: DataFrame) -> DataFrame:
    """__ld_rid, __ld_rth, __ld_n: of rows equal in doc_id and text, where there are several, their number."""
    rows = docs.select(F.col("doc_id").alias("__ld_rid"), F.xxhash64("text").alias("__ld_rth"))
    return rows.groupBy("__ld_rid", "__ld_rth").agg(F.count(F.lit(1)).alias("__ld_n")).where(F.col("__ld_n") > 1)


def shared_keys(hashes: DataFrame, repeated: DataFrame, min_docs: int) -> DataFrame:
    """Keys found in at least min_docs documents, with their first occurrence; repeated as in repeated_rows().

    The salted partial counts are what is range-partitioned: a key has at most
    SALTS rows there, so the window's groups are bounded.
    """
    rows = hashes.groupBy("h1", "h2", "__ld_id", "__ld_th").agg(F.min("__ld_pos").alias("pos"))
    same = F.col("__ld_id").eqNullSafe(F.col("__ld_rid")) & (F.col("__ld_th") == F.col("__ld_rth"))
    rows = rows.join(small(reliable_checkpoint(repeated)), same, "left")
    salted = rows.groupBy("h1", "h2", F.pmod(F.xxhash64("__ld_id"), F.lit(SALTS)).alias("salt")).agg(
        F.sum(F.coalesce("__ld_n", F.lit(1))).alias("n"), F.min(F.struct("__ld_id", "__ld_th", "pos")).alias("first")
    )
    ranged = salted.repartitionByRange(partitions(hashes.sparkSession), "h1", "h2").sortWithinPartitions("h1", "h2", "first")
    key = Window.partitionBy("h1", "h2").orderBy("first")
    whole = key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        ranged.select("h1", "h2", "first", F.sum("n").over(whole).alias("n_docs"), F.row_number().over(key).alias("rn"))
        .where((F.col("rn") == 1) & (F.col("n_docs") >= min_docs))
        .drop("rn")
    )


def drop_bitmaps(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """Per document with dropped lines: (doc_id, text_hash, runs), runs = [first, last] line numbers dropped.

    keep_first leaves the first occurrence of a key (smallest doc_id, then position) in place.
    """
    hashes = line_hashes(docs)
    keys = reliable_checkpoint(shared_keys(hashes, repeated_rows(docs), min_docs))
    hit = hashes.join(keys, ["h1", "h2"])
    if keep_first:
        at = F.struct(F.col("__ld_id"), F.col("__ld_th"), F.col("__ld_pos").alias("pos"))
        hit = hit.where(~at.eqNullSafe(F.col("first")))
    pos = hit.groupBy("__ld_id", "__ld_th").agg(F.sort_array(F.collect_set("__ld_pos")).alias("p"))
    starts = F.filter("p", lambda x, i: (i == 0) | (F.get(F.col("p"), i - 1) != x - 1))
    ends = F.filter("p", lambda x, i: (i == F.size("p") - 1) | (F.get(F.col("p"), i + 1) != x + 1))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    return pos.select(F.col("__ld_id").alias("doc_id"), F.col("__ld_th").alias("text_hash"), runs.alias("runs"))


def _apply(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """docs plus __ld_ls (lines) and __ld_runs (dropped runs, empty if none)."""
    b = bitmaps.select(F.col("doc_id").alias("__ld_id"), F.col("text_hash").alias("__ld_th"), F.col("runs").alias("__ld_runs"))
    d = docs.withColumns({"__ld_id2": F.col("doc_id"), "__ld_th2": F.xxhash64("text")})
    none = F.expr("CAST(array() AS array<struct<first:int,last:int>>)")
    return (
        d.join(b, F.col("__ld_id2").eqNullSafe(F.col("__ld_id")) & (F.col("__ld_th2") == F.col("__ld_th")), "left")
        .withColumns({"__ld_runs": F.coalesce("__ld_runs", none), "__ld_ls": _lines(F.col("text"))})
        .drop("__ld_id", "__ld_th", "__ld_id2", "__ld_th2")
    )


def _kept() -> Column:
    """The lines between the dropped runs, cut out run by run."""
    r, ls = F.col("__ld_runs"), F.col("__ld_ls")

    def piece(j: Column) -> Column:
        start = F.when(j == 0, F.lit(0)).otherwise(F.get(r, j - 1)["last"] + 1)
        stop = F.when(j == F.size(r), F.size(ls)).otherwise(F.get(r, j)["first"])
        return F.slice(ls, start + 1, stop - start)

    cut = F.flatten(F.transform(F.sequence(F.lit(0), F.size(r)), piece))
    return F.when(F.size(r) == 0, F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(cut, "\n"))


def dedup_report(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    d = _apply(docs.select("doc_id", "text"), drop_bitmaps(docs, min_docs, keep_first))
    dropped = F.aggregate("__ld_runs", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"] + 1)
    return d.select(
        "doc_id", F.size("__ld_ls").cast("long").alias("n_lines"), dropped.alias("n_dropped"), F.sha2(_kept(), 256).alias("kept_sha256")
    )


def drop_lines(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """The documents with their shared lines gone; same columns, a text without dropped lines (null included) as it was."""
    d = _apply(docs, drop_bitmaps(docs, min_docs, keep_first))
    text = F.when(F.size("__ld_runs") == 0, F.col("text")).otherwise(_kept())
    return d.select(*(text.alias(c) if c == "text" else F.col(c) for c in docs.columns))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT r, i, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.r, k.i, k.line, shared.key IS NOT NULL AS gone FROM k LEFT JOIN shared ON k.key = shared.key),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT d.doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM g JOIN d USING (r)
"""
