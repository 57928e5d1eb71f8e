"""Source divergence audit: how far the word shares of a language's sources lie from each other and from the language.

Terms: maximal runs of ASCII letters and of bytes beyond ASCII, A-Z lower-cased.
A language keeps the terms that are in at least min_docs of its documents.  A
(language, source) group, and a language, gives a kept term
p = 1 + floor(1000000000 * (count + 5) / (N + 5 * V)), N being its occurrences of
all V kept terms.  Two sources diverge by the sum of |p - q| over all kept terms;
a group is marked by the terms whose p exceeds the language's most.

Method, three-dimensional cube partitioning: a language's groups fall into
blocks of GROUP_BLOCK in order of their source, its terms into hashed blocks of
about TERM_BLOCK.  A cell is (group block, group block, term block): its task
gets both blocks' slices of the counts (a slice is replicated to the cells of
its row and column, one per group block), lays them out as two matrices of p
and sums |p - q| over its terms for every pair of sources.  The partial
divergences are then summed along the term axis.  A cell holds at most
2 * GROUP_BLOCK rows of its terms, whatever the corpus.  Terms that neither
block has stand in the cell as a number: all their p are those of count 0.

All arithmetic is on integers (products in decimals), so results are exact.

Defined results: null text, lang and source count as empty; every occurring
(lang, source) is a group, even without terms; rows are documents, so repeated
rows count each; a language without kept terms gives its pairs with value 0 and
no terms; a language with one source has no pairs; very long texts need memory
in proportion to their own length; an empty table gives an empty result.  Only
text, lang and source are read, so other columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import small, stored
from souk.session import reliable_checkpoint

SCALE = 1_000_000_000
SMOOTH = 5
#: Groups of a block and, about, terms of a block.
GROUP_BLOCK = 64
TERM_BLOCK = 4096
#: Distinct (group, term) entries a task holds before it hands them on.
ENTRIES = 400_000
# Bytes of terms (letters and what is not ASCII) map to themselves in small letters, all others to a space.
TERM_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group and term, the documents and occurrences of this task so far; a row without a term names a group."""
    total: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for (lang, source), (docs, times) in total.items():
            names = [None, *times]
            n = len(names)
            cols = [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(names, pa.binary()).cast(pa.string())]
            cols += [pa.array([0, *(docs[t] for t in times)], pa.int64()), pa.array([0, *times.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "docs", "times"])
        total.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
            found = terms(text.as_py() or "")
            docs, times = total.setdefault((lang or "", source or ""), (Counter(), Counter()))
            before = len(times)
            docs.update(set(found))
            times.update(found)
            held += len(times) - before
            if held > ENTRIES:
                yield from emit()
                held = 0
    yield from emit()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, docs (documents that hold it) and times (occurrences); one row per group has a null term."""
    d = docs.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    d = d.mapInArrow(_count, "lang string, source string, term string, docs long, times long")
    return d.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"))


def share(count: str, total: str, terms_: str) -> Column:
    """p of a count: 1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms))."""
    return F.expr(f"1L + (CAST({count} + {SMOOTH} AS DECIMAL(19,0)) * {SCALE}BD) div CAST({total} + {SMOOTH} * {terms_} AS DECIMAL(20,0))")


def groups(counts: DataFrame, kept: DataFrame, rows: DataFrame, group_block: int, term_block: int) -> DataFrame:
    """One row per (lang, source): total (its N), v and lang_total (the language's), place and block among the language's groups, term_blocks and none (p of count 0)."""
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_count").alias("lang_total"))
    own = rows.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    g = counts.where("term IS NULL").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    g = g.fillna(0, ["total", "v", "lang_total"])
    g = g.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    g = g.withColumn("block", F.floor(F.col("place") / group_block).cast("int"))
    g = g.withColumn("blocks", F.max("block").over(Window.partitionBy("lang")) + 1)
    g = g.withColumn("term_blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / term_block)).cast("int"))
    return g.withColumn("none", F.when(F.col("v") > 0, share("0", "total", "v")).otherwise(F.lit(0).cast("long")))


def _cells(df: DataFrame) -> DataFrame:
    """df once for every cell of its group block's row and column: i <= j and whose side it is."""
    at = F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    d = df.select("*", at)
    return d.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")


def _partial(key: tuple, cell: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of a cell's pairs of sources, over the terms of its block."""
    lang, i, j, _ = key
    heads = cell[cell["slot"].isna()]
    body = cell[cell["slot"].notna()]
    n_terms = int(heads["n_terms"].iloc[0]) if len(heads) else 0
    slots, column = np.unique(body["slot"].to_numpy(np.int64), return_inverse=True)

    def matrix(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mine = heads[heads["block"] == block].sort_values("place")
        places, none = mine["place"].to_numpy(np.int64), mine["p"].to_numpy(np.int64)
        p = np.repeat(none[:, None], len(slots), axis=1)
        of = (body["block"] == block).to_numpy()
        p[np.searchsorted(places, body["place"].to_numpy(np.int64)[of]), column[of]] = body["p"].to_numpy(np.int64)[of]
        return places, none, p

    places, none, p = matrix(i)
    others, none2, q = matrix(j) if i != j else (places, none, p)
    a, b, value = [], [], []
    for k in range(len(places)):
        later = slice(k + 1 if i == j else 0, None)
        far = np.abs(q[later] - p[k]).sum(axis=1) + np.abs(none2[later] - none[k]) * (n_terms - len(slots))
        a.append(np.full(len(far), places[k]))
        b.append(others[later])
        value.append(far)
    flat = [np.concatenate([np.empty(0, np.int64), *x]) for x in (a, b, value)]
    return pd.DataFrame({"lang": lang, "a": flat[0], "b": flat[1], "value": flat[2]})


def pair_divergences(rows: DataFrame, kept: DataFrame, g: DataFrame) -> DataFrame:
    """lang, source, item (another source) and value, for every ordered pair of a language's sources."""
    layout = g.select("lang", "source", "place", "block", "blocks", "term_blocks", "total", "v")
    t_block = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("t")
    body = rows.join(small(layout), ["lang", "source"]).withColumn("p", share("count", "total", "v"))
    body = body.select("lang", "place", "block", "blocks", t_block, F.xxhash64(F.lit("slot"), "term").alias("slot"), "p", F.lit(None).cast("long").alias("n_terms"))
    sizes = kept.join(small(g.select("lang", "term_blocks").distinct()), "lang").select("lang", t_block).groupBy("lang", "t").agg(F.count(F.lit(1)).alias("n"))
    head = g.select("lang", "place", "block", "blocks", F.explode(F.expr("sequence(0, term_blocks - 1)")).alias("t"), F.col("none").alias("p"))
    head = head.join(sizes, ["lang", "t"], "left")
    head = head.select("lang", "place", "block", "blocks", "t", F.lit(None).cast("long").alias("slot"), "p", F.coalesce("n", F.lit(0)).cast("long").alias("n_terms"))
    cells = _cells(body.unionByName(head)).select("lang", "i", "j", "t", "block", F.col("place").cast("long").alias("place"), "slot", "p", "n_terms")
    partial = cells.groupBy("lang", "i", "j", "t").applyInPandas(_partial, "lang string, a long, b long, value long")
    whole = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = whole.select("lang", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("z"), "value")
    name = g.select("lang", F.col("place").cast("long").alias("place"), "source")
    x = both.select("lang", F.col("z.x").alias("x"), F.col("z.y").alias("y"), "value")
    x = x.join(small(name.withColumnsRenamed({"place": "x"})), ["lang", "x"])
    return x.join(small(name.withColumnsRenamed({"place": "y", "source": "item"})), ["lang", "y"]).select("lang", "source", "item", "value")


def marking_terms(rows: DataFrame, g: DataFrame) -> DataFrame:
    """lang, source, item (a kept term of the group whose p exceeds the language's) and value."""
    r = rows.join(small(g.select("lang", "source", "total", "v", "lang_total")), ["lang", "source"])
    r = r.select("lang", "source", F.col("term").alias("item"), (share("count", "total", "v") - share("lang_count", "lang_total", "v")).alias("value"))
    return r.where(F.col("value") > 0)


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value and rank: all pairs of a language's sources and each group's top terms."""
    counts = stored(term_counts(docs))
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("n_docs"), F.sum("times").alias("lang_count"))
    kept = reliable_checkpoint(kept.where(F.col("n_docs") >= min_docs).drop("n_docs"))
    rows = stored(counts.where("times > 0").select("lang", "source", "term", F.col("times").alias("count")).join(kept, ["lang", "term"]))
    g = reliable_checkpoint(groups(counts, kept, rows, group_block, term_block))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pair = pair_divergences(rows, kept, g).withColumn("rank", F.row_number().over(order))
    term = marking_terms(rows, g).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pair.withColumn("part", F.lit("pair")).select(*columns).unionByName(term.withColumn("part", F.lit("term")).select(*columns))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT DISTINCT lang FROM d),
w AS (SELECT r, lang, source, translate(unnest(ts), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lc FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
lt AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(lc) AS HUGEINT) AS total FROM k GROUP BY lang),
gt AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(gt.total, 0) + 5 * lt.v) AS p,
             1 + (1000000000 * (k.lc + 5)) // (lt.total + 5 * lt.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN lt ON lt.lang = g.lang
      LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pv.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
tv AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
u AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM tv))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM u WHERE part = 'pair' OR rank <= 50
"""
