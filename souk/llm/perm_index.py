"""Nearest neighbours by a permutation index.

A vector is represented by its PREFIX nearest of PIVOTS pivots in order
(pivots: a bounded hash sample of the vectors).  Within a block of rows every
pivot has an inverted file of the rows that rank it, with their ranks.  A query
walks the files of its own pivots; for prefixes of length L the footrule
distance is a constant less 2 * sum over shared pivots of min(L - rank in the
query, L - rank in the row), so what is summed up is that similarity.  The rows
with the smallest footrule distance (a share WIDTH of the block, and all that
reach half of the query's similarity to itself, so that a large group of near
copies is never cut) are ranked again by the exact inner product in double
precision on the original vectors.

Inner products grow with length, directions alone rank pivots: blocks hold
rows of about equal length (quarter octaves), so the share of every length
class is looked at.  Blocks are dealt by a hash and have at most about BLOCK
rows whatever the skew; queries are dealt in chunks, and a task works on one
chunk against one block.  A cell hands on the k nearest of each query.

Rows equal in vec_id and vector are one entry with their number, looked up once.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part; a row without vec_id is a candidate (its vec_id comes
back as null) and no query; rows that share a vec_id are rows of their own, as
queries (each has its k rows) and as candidates of one another; vectors of
another length (dimension) than the query's are not its candidates; ties go to
the smaller vec_id, null last; with fewer candidates than k all that were found
come back; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.common import partitions
from souk.llm.vectors import doubles, matrix, sample, unit, usable
from souk.session import reliable_checkpoint

PIVOTS = 256
PREFIX = 64
WIDTH = 0.15
NEAR = 0.5
BLOCK = 8192
CHUNK = 1024


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each row its nearest pivots in order (ties to the lower pivot)."""
    near = -(unit(x) @ pivots.T)
    return np.argsort(near, axis=1, kind="stable")[:, :prefix].astype(np.int32)


class InvertedFiles:
    """The pivots' files over the entries of a block: name, n (equal rows) and vector of each."""

    def __init__(self, name: np.ndarray, n: np.ndarray, x: np.ndarray, pivots: np.ndarray, prefix: int):
        self.name, self.n, self.x, self.prefix = name, n, x, prefix
        perm = permutations(x, pivots, prefix)
        order = np.argsort(perm, axis=None, kind="stable")
        self.rows = (order // prefix).astype(np.int32)
        self.weights = (prefix - order % prefix).astype(np.int32)
        self.bounds = np.searchsorted(perm.ravel()[order], np.arange(len(pivots) + 1))

    def similarity(self, perm: np.ndarray) -> np.ndarray:
        """Per entry, half of what its footrule distance falls short of the greatest."""
        out = np.zeros(len(self.name), np.int32)
        for rank, p in enumerate(perm):
            a, b = self.bounds[p], self.bounds[p + 1]
            out[self.rows[a:b]] += np.minimum(self.weights[a:b], self.prefix - rank)
        return out

    def search(self, name: int, q: np.ndarray, perm: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and score of the entries that hold the k rows found nearest to an entry `name`, its own row left out."""
        s = self.similarity(perm)
        wide = min(len(s), max(4 * k, int(np.ceil(WIDTH * len(s)))))
        reach = min(np.partition(s, len(s) - wide)[len(s) - wide], int(NEAR * self.prefix * (self.prefix + 1) / 2))
        at = np.flatnonzero((s >= reach) & ((self.name != name) | (self.n > 1)))
        score = (self.x[at] * q).sum(axis=1)
        if len(at) > k:
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[keep], score[keep]
        return at, score


def _cells(pivots: dict[int, np.ndarray], k: int):
    names = ["query", "query_id", "asked", "name", "vec_id", "n", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, files = None, [], None
        for batch in batches:
            block, chunk, kind, dim, name, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("block", "chunk", "is_query", "dim", "name", "n"))
            new = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(new, np.r_[new[1:], len(block)]):
                x, ids = matrix(batch["v"].slice(a, b - a), int(dim[a])), batch["vec_id"].slice(a, b - a)
                if cell != (block[a], chunk[a]):
                    cell, held, files = (block[a], chunk[a]), [], None
                if not kind[a]:
                    held.append((name[a:b], n[a:b], x, ids))
                    continue
                if not held:
                    continue
                p = pivots[int(dim[a])]
                prefix = min(PREFIX, len(p))
                if files is None:
                    files = InvertedFiles(*(np.concatenate([h[i] for h in held]) for i in range(3)), p, prefix)
                    vec_id = pa.concat_arrays([h[3] for h in held])
                    # ties go to the smaller vec_id: the place of each entry in that order, null last
                    order = np.empty(len(vec_id), np.int64)
                    order[pa.compute.sort_indices(vec_id, null_placement="at_end").to_numpy()] = np.arange(len(vec_id))
                asked, place, score = [], [], []
                for i, (who, q, perm) in enumerate(zip(name[a:b], x, permutations(x, p, prefix))):
                    at, s = files.search(who, q, perm, k)
                    best = np.lexsort((order[at], -s))[:k]
                    asked.append(np.full(len(best), i))
                    place.append(at[best])
                    score.append(s[best])
                asked, place = np.concatenate(asked), np.concatenate(place)
                out = [name[a:b][asked], ids.take(pa.array(asked)), n[a:b][asked], files.name[place], vec_id.take(pa.array(place)), files.n[place], np.concatenate(score)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in out], names)

    return run


def search(embeddings: DataFrame, every: int = 20, k: int = 20, sample_rows: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found nearest to every row whose vec_id is divisible by `every`."""
    spark = embeddings.sparkSession
    d = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), doubles("embedding").alias("v")).where(usable(F.col("v")))
    # an entry: all rows equal in vec_id and vector; zero has one sign
    d = d.withColumn("v", F.transform("v", lambda x: x + 0.0)).withColumn("h", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v"))
    d = d.groupBy("vec_id", "h", "h2").agg(F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    d = d.select(F.xxhash64("vec_id", "h", "h2").alias("name"), "vec_id", "n", "v")
    top = F.array_max(F.transform("v", F.abs))
    length = F.log2(top) + F.log2(F.aggregate(F.transform("v", lambda x: F.pow(x / top, 2)), F.lit(0.0), lambda a, x: a + x)) / 2
    d = reliable_checkpoint(d.select("name", "vec_id", "n", "v", F.size("v").alias("dim"), F.floor(4 * length).cast("int").alias("long")))
    # one row per dimension and length class
    sizes = d.groupBy("dim", "long").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.pmod("vec_id", F.lit(every)) == 0).cast("long")), F.lit(0)).alias("q")).orderBy("dim", "long").collect()
    pivots, kinds, first = {}, [], 0
    for dim in sorted({r["dim"] for r in sizes}):
        own = [r for r in sizes if r["dim"] == dim]
        total = sum(r["n"] for r in own)
        pivots[dim] = sample(d.where(F.col("dim") == dim), "v", sample_rows, total, F.xxhash64(F.lit("pivot"), "name"))[:sample_rows]
        if not len(pivots[dim]):  # a very small table may have no row in the sample
            pivots[dim] = unit(np.array([d.where(F.col("dim") == dim).orderBy("name").first()["v"]]))
        start = first
        for r in own:
            n = -(-r["n"] // BLOCK)
            kinds.append((dim, r["long"], first, n, start, 0, 0))
            first += n
        chunks = max(1, -(-sum(r["q"] for r in own) // CHUNK))
        kinds = [(*x[:5], first - 1, chunks) if x[0] == dim else x for x in kinds]
    table = spark.createDataFrame(kinds, "dim int, long int, first int, blocks int, low int, high int, chunks int")
    d = d.join(F.broadcast(table), ["dim", "long"])
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "name"), F.col(n)).cast("int")
    rows = d.select("name", "vec_id", "n", "v", "dim", (F.col("first") + deal("block", "blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("is_query"))
    asked = d.where(F.pmod("vec_id", F.lit(every)) == 0)
    asked = asked.select("name", "vec_id", "n", "v", "dim", F.explode(F.sequence("low", "high")).alias("block"), deal("chunk", "chunks").alias("chunk"), F.lit(1).alias("is_query"))
    cells = rows.unionByName(asked).repartition(partitions(spark), "block", "chunk").sortWithinPartitions("block", "chunk", "is_query")
    found = cells.mapInArrow(_cells(pivots, k), "query long, query_id long, asked long, name long, vec_id long, n long, score double")
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "name")
    found = found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)  # the best k entries hold the best k rows
    found = found.withColumn("n", F.col("n") - (F.col("query") == F.col("name")).cast("long"))
    before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = found.withColumn("before", before).where(F.col("before") < k)
    found = found.withColumn("rank", F.explode(F.expr(f"sequence(CAST(before AS INT) + 1, CAST(least(before + n, {k}) AS INT))")))
    # every one of the equal rows that ask
    return found.select(F.explode(F.sequence(F.lit(1).cast("long"), "asked")), "*").select("query_id", "rank", "vec_id", "score")
