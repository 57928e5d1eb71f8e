"""Embedding near-duplicates by product quantisation with inverted lists.

Equal vectors are one class first.  A coarse quantiser (k-means on a bounded
hash sample) assigns every class to the inverted list of its nearest centre;
the residual to the centre is stored as one code per subspace.  A class probes
its own list and every other list whose Voronoi cell can hold a vector within
the threshold: with r the distance at the threshold, the boundary between its
own centre and the other is at most SLACK * r away.  At SLACK = 1 that is the
triangle bound and no link can be missed; below 1, links along the line between
two centres would be.  In a list, one table look-up per subspace gives the inner
product of a query with every member's quantised vector; the member's stored
error terms turn the threshold into a bound per member, again with SLACK, and
what passes is ranked by the exact cosine in double precision.

The sound bound leaves out few lists, and a class is sent to every list it
probes, so a table gets as many lists as hold half a CHUNK each, up to the root
of its size.  Lists are dealt into chunks of about CHUNK members, so a list that holds a third
of all rows is many tasks.  A comparison does not hand on pairs: it hands on,
per vector, the number of vectors it links with, and links that span the
components of the cell.

Defined results: vectors that are null, zero or hold null or non-finite
components link with nothing (n_links 0, a component of their own); rows without
vec_id link and count like others, have the smallest vec_id they reach as their
component (null if there is none) and are not kept; vectors of different lengths
(dimensions) do not link; rows equal in vector are linked, and count, as often
as they occur, also under one vec_id; other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import partitions
from souk.llm.components import connected_components
from souk.llm.vectors import doubles, k_means, matrix, nearest, sample, unit, usable
from souk.session import reliable_checkpoint

THRESHOLD = 0.9
#: Share of the triangle bounds that is searched; links are lost below 1.
SLACK = 1.0
CHUNK = 2048
SAMPLE = 8192
MAX_LISTS = 4096
SUBSPACES = 8
CODES = 256
#: Queries that are looked up against a chunk at a time.
QUERIES = 128


@dataclass
class Quantiser:
    centres: np.ndarray
    cuts: list[int]  # bounds of the subspaces
    codebooks: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, lists: int) -> Quantiser:
        centres = k_means(x, lists, 8, 1)
        rest = x - centres[nearest(x, centres)]
        cuts = [int(c) for c in np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1)]
        books = [k_means(rest[: SAMPLE // 2, a:b], CODES, 6, 2) for a, b in zip(cuts, cuts[1:])]
        return cls(centres, cuts, books)

    def encode(self, x: np.ndarray, centre: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the unit rows of a list: codes, length of the quantisation error, and the row's inner product with it."""
        rest = x - self.centres[centre]
        codes = np.empty((len(x), len(self.codebooks)), np.uint8)
        back = np.repeat(self.centres[centre][None], len(x), axis=0)
        for s, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            codes[:, s] = nearest(rest[:, a:b], self.codebooks[s])
            back[:, a:b] += self.codebooks[s][codes[:, s]]
        error = x - back
        return codes, np.sqrt((error**2).sum(axis=1)), (x * error).sum(axis=1)

    def probes(self, x: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
        """bool[rows, lists]: the other lists whose cell is within reach of the row."""
        d2 = (self.centres**2).sum(axis=1) - 2 * (x @ self.centres.T)
        c2 = (self.centres**2).sum(axis=1)
        apart = np.sqrt(np.maximum(c2[:, None] + c2 - 2 * (self.centres @ self.centres.T), 1e-30))
        near = (d2 - d2[np.arange(len(x)), own][:, None]) / (2 * apart[own]) <= reach + 1e-9
        near[np.arange(len(x)), own] = False
        return near

    def products(self, q: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric look-up: inner products of the queries with the members' quantised vectors."""
        # a member's code picks a row of products with all queries
        out = np.repeat((q @ self.centres[centre]).astype(np.float32)[None], len(codes), axis=0)
        for s, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            out += (self.codebooks[s] @ q[:, a:b].T).astype(np.float32)[codes[:, s]]
        return out.T


def _forest(linked: np.ndarray) -> np.ndarray:
    """Component label (lowest row) of each row of a symmetric bool matrix."""
    label, seen = np.arange(len(linked)), np.zeros(len(linked), bool)
    for i in np.flatnonzero(linked.any(axis=1)):
        if seen[i]:
            continue
        front = np.zeros(len(linked), bool)
        front[i] = True
        while front.any():
            seen |= front
            label[front] = i
            front = linked[front].any(axis=0) & ~seen
    return label


class _Cell:
    """A chunk of an inverted list: members, and what queries have found there."""

    def __init__(self, quantiser: Quantiser, centre: int, node: np.ndarray, n: np.ndarray, x: np.ndarray, threshold: float):
        self.q, self.centre, self.node, self.n, self.x, self.threshold = quantiser, centre, node, n, x, threshold
        self.u = unit(x)
        self.codes, error, along = quantiser.encode(self.u, centre)
        self.bound = (threshold - along - SLACK * np.sqrt(2 - 2 * threshold) * error - 1e-5).astype(np.float32)
        self.length = np.sqrt((x * x).sum(axis=1))

    def links(self, x: np.ndarray) -> np.ndarray:
        """bool[queries, members]: exact cosine at the threshold or above, among the pairs that pass the look-up."""
        passed = np.concatenate([self.q.products(u, self.centre, self.codes) >= self.bound for u in np.array_split(unit(x), -(-len(x) // QUERIES))])
        i, j = np.nonzero(passed)
        length = np.sqrt((x * x).sum(axis=1))
        for a in range(0, len(i), 100_000):
            p, m = i[a : a + 100_000], j[a : a + 100_000]
            cosine = (x[p] * self.x[m]).sum(axis=1) / (length[p] * self.length[m])
            passed[p, m] = cosine >= self.threshold
        return passed

    def own(self) -> list[tuple[np.ndarray, ...]]:
        linked = self.links(self.x)
        linked |= linked.T
        np.fill_diagonal(linked, False)
        self.label = _forest(linked)
        out = [_counts(self.node, linked @ self.n)]
        moved = np.flatnonzero(self.label != np.arange(len(self.label)))
        return [*out, _edges(self.node[moved], self.node[self.label[moved]])]

    def ask(self, node: np.ndarray, n: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        linked = self.links(x)
        i, j = np.nonzero(linked)
        roots = np.unique(i * np.int64(len(self.node)) + self.label[j])  # a query and a component of the chunk meet once
        return [
            _counts(node, linked @ self.n),
            _counts(self.node, n @ linked),
            _edges(node[roots // len(self.node)], self.node[roots % len(self.node)]),
        ]


def _counts(node: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, ...]:
    at = links > 0
    return node[at], np.zeros(at.sum(), np.int64), links[at].astype(np.int64)


def _edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
    return u, v, np.zeros(len(u), np.int64)


def _compare(quantisers: dict[int, Quantiser], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, cell = None, [], None

        def emit(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], ["u", "v", "links"])

        def ready() -> _Cell | None:
            if not held:
                return None
            node, n, x = (np.concatenate(c) for c in zip(*held))
            return _Cell(quantisers[at[0]], at[1], node, n, x, threshold)

        for batch in batches:
            dim, centre, chunk, kind, node, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("dim", "list", "chunk", "asks", "node", "n"))
            new = np.flatnonzero(np.r_[True, (dim[1:] != dim[:-1]) | (centre[1:] != centre[:-1]) | (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(new, np.r_[new[1:], len(dim)]):
                x = matrix(batch["v"].slice(a, b - a), int(dim[a]))
                key = (int(dim[a]), int(centre[a]), int(chunk[a]))
                if key != at:
                    if cell is None and (last := ready()):
                        yield emit(last.own())
                    at, held, cell = key, [], None
                if not kind[a]:
                    held.append((node[a:b], n[a:b], x))
                    continue
                if cell is None:
                    cell = ready()
                    if cell is None:
                        continue
                    yield emit(cell.own())
                for s in range(0, b - a, 4 * QUERIES):
                    t = slice(a + s, min(b, a + s + 4 * QUERIES))
                    yield emit(cell.ask(node[t], n[t], x[s : s + 4 * QUERIES]))
        if cell is None and (last := ready()):
            yield emit(last.own())

    return run


def _probe(quantisers: dict[int, Quantiser], chunks: dict[tuple[int, int], int], threshold: float):
    """Every class as a member of its list's chunk, and as a query of later chunks of it and of the higher lists it probes."""
    reach = SLACK * float(np.sqrt(2 - 2 * threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                part = batch.slice(lo, 2048)
                dims, deal = part["dim"].to_numpy(zero_copy_only=False), part["deal"].to_numpy(zero_copy_only=False)
                for dim in np.unique(dims):
                    q, rows = quantisers[int(dim)], np.flatnonzero(dims == dim)
                    u = unit(matrix(part["v"].take(pa.array(rows)), int(dim)))
                    own = nearest(u, q.centres)
                    n_chunks = np.array([chunks.get((int(dim), c), 1) for c in range(len(q.centres))])
                    mine = deal[rows] % n_chunks[own]
                    i, c = np.nonzero(q.probes(u, own, reach) & (np.arange(len(q.centres)) > own[:, None]))
                    i, c = np.repeat(i, n_chunks[c]), np.repeat(c, n_chunks[c])
                    # the chunks of a probed list, one after another
                    first = np.r_[True, (i[1:] != i[:-1]) | (c[1:] != c[:-1])] if len(i) else np.empty(0, bool)
                    starts = np.flatnonzero(first)
                    k = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)])) if len(i) else i
                    later = [np.arange(m + 1, n_chunks[o]) for m, o in zip(mine, own)]
                    i2 = np.repeat(np.arange(len(rows)), [len(x) for x in later])
                    k2 = np.concatenate(later) if later else np.empty(0, np.int64)
                    at = rows[np.r_[np.arange(len(rows)), i, i2]]
                    cols = [
                        pa.array(np.r_[own, c, own[i2]].astype(np.int32)),
                        pa.array(np.r_[mine, k, k2].astype(np.int32)),
                        pa.array(np.r_[np.zeros(len(rows)), np.ones(len(i) + len(i2))].astype(np.int32)),
                        *(part[x].take(pa.array(at)) for x in ("dim", "node", "n", "v")),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, ["list", "chunk", "asks", "dim", "node", "n", "v"])

    return run


def _lists(quantisers: dict[int, Quantiser]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                own = nearest(unit(matrix(batch["v"].take(pa.array(np.flatnonzero(dims == dim))), int(dim))), quantisers[int(dim)].centres)
                c, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([int(dim)] * len(c), pa.int32()), pa.array(c.astype(np.int32)), pa.array(n)], ["dim", "list", "n"])

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    spark = embeddings.sparkSession
    v = doubles("embedding")
    all_rows = embeddings.select(F.col("vec_id"), v.alias("v"))
    # a class is a distinct vector, named by its hash; zero has one sign
    all_rows = all_rows.withColumn("v", F.when(usable(F.col("v")), F.transform("v", lambda x: x + 0.0)))
    rows = reliable_checkpoint(all_rows.select("vec_id", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("node"), F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v")).alias("check"), "v"))
    classes = rows.where(F.col("node").isNotNull()).groupBy("node", "check").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    classes = reliable_checkpoint(classes.select("node", "check", "low", "n", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64(F.lit("deal"), "node"), F.lit(1 << 30)).alias("deal")))
    sizes = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    quantisers = {}
    for dim, total in sorted(sizes.items()):
        x = sample(classes.where(F.col("dim") == dim), "v", SAMPLE, total, F.xxhash64(F.lit("quantiser"), "node"))[:SAMPLE]
        if not len(x):
            x = unit(np.array([classes.where(F.col("dim") == dim).orderBy("node").first()["v"]]))
        quantisers[dim] = Quantiser.fit(x, int(np.clip(round(min(total**0.5, 2 * total / CHUNK)), 1, MAX_LISTS)))
    if quantisers:
        per_list = classes.select("dim", "v").mapInArrow(_lists(quantisers), "dim int, list int, n long").groupBy("dim", "list").agg(F.sum("n").alias("n")).collect()
        chunks = {(r["dim"], r["list"]): -(-r["n"] // CHUNK) for r in per_list}
        asked = classes.select("dim", "node", "n", "v", "deal").mapInArrow(_probe(quantisers, chunks, threshold), "list int, chunk int, asks int, dim int, node long, n long, v array<double>")
        cells = asked.repartition(partitions(spark), "dim", "list", "chunk").sortWithinPartitions("dim", "list", "chunk", "asks")
        found = reliable_checkpoint(cells.mapInArrow(_compare(quantisers, threshold), "u long, v long, links long"))
    else:
        found = spark.createDataFrame([], "u long, v long, links long")
    links = found.where(F.col("links") > 0).groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    reached = connected_components(found.where(F.col("links") == 0).select("u", "v"))
    named = classes.select("node", "check", "low", "n").join(links, "node", "left").join(reached, "node", "left").withColumn("root", F.coalesce("component", "node"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = reliable_checkpoint(named.join(low, "root").select("node", "check", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    out = rows.select("vec_id", "node", "check").join(named, ["node", "check"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
