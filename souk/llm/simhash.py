"""SimHash near-duplicates over a byte-position inverted index with count filtering.

Fingerprints that differ in at most three bits differ in at most three of
their eight bytes, so they share at least five positional bytes, and at least
three of any six positions.  The index posts each distinct fingerprint under
the 20 triples of its first six positional bytes; within a posting list the
shared positional bytes of a pair are tallied, pairs below the guaranteed
minimum are dropped, and the rest verified by bit distance.

Lists longer than CELL are dealt into chunks and compared chunk against chunk,
so no task holds more than about two chunks of a list; a comparison hands on a
spanning forest of the links in its cell, not all pairs.  Equal fingerprints
are one node of the index whatever their number.

Defined results: a null or blank text has fingerprint zero and links like any
other; a null doc_id is carried along, and a group's component_id is its
smallest non-null doc_id, which groups may share or lack, so one document is
kept per group, not per component_id; repeated rows share a group; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import partitions
from souk.llm.components import connected_components
from souk.session import reliable_checkpoint

SEED = 42
#: Members of a chunk of a posting list.
CELL = 2048
#: Up to this length a list is compared at once by shifting, beyond it member by member.
SMALL = 32
_BLOCK = 1 << 14


def fingerprint(raw: bytes | None, shingle: int) -> int:
    """The 64-bit SimHash of a UTF-8 text: word shingles, repeats included; zero without words."""
    words = (raw or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts = ends - length
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK])), np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b["raw"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(fps, pa.int64())], ["doc_id", "text_hash", "fp"])

    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("raw"))
    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def _byte(i: int) -> Column:
    return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255).cast("long"))


def _postings(nodes: DataFrame, max_bits: int) -> DataFrame:
    """key, fp: the fingerprint under every choice of (positions - max_bits) of its first six positional bytes."""
    chosen = list(combinations(range(6), 6 - max_bits))

    def key(n: int, at: tuple[int, ...]) -> Column:
        out = F.lit(n).cast("long")
        for i in at:
            out = F.shiftleft(out, 8).bitwiseOR(_byte(i))
        return out

    return nodes.select("fp", F.explode(F.array(*(key(n, at) for n, at in enumerate(chosen)))).alias("key"))


def _close(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Of the XORs of pairs: those that share enough positional bytes and then differ in few enough bits."""
    near = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= 8 - max_bits
    near[near] = np.bitwise_count(x[near]) <= max_bits
    return near


def _links(fp: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups (runs of equal numbers): all of small groups, a spanning forest of large ones."""
    us, vs = [], []
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    small = np.repeat(sizes <= SMALL, sizes)
    for shift in range(1, min(SMALL, len(fp))):
        i = np.flatnonzero((group[shift:] == group[:-shift]) & small[shift:])
        if not len(i):
            break
        i = i[_close(fp[i] ^ fp[i + shift], max_bits)]
        us.append(fp[i])
        vs.append(fp[i + shift])
    for a, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        rest = np.unique(fp[a : a + n])
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                u = queue.pop()
                near = _close(rest ^ u, max_bits)
                found, rest = rest[near], rest[~near]
                us.append(np.full(len(found), u))
                vs.append(found)
                queue.extend(found)
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *us]), np.concatenate([none, *vs])


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def emit(cols: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            key, a, b, fp = cols
            new = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            u, v = _links(fp.view(np.uint64), np.r_[0, np.cumsum(new)], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            held.append(tuple(batch[c].to_numpy(zero_copy_only=False) for c in ("key", "a", "b", "fp")))
            cols = tuple(np.concatenate(x) for x in zip(*held))
            key, a, b, _ = cols
            if not len(key):
                continue
            # rows are sorted: the last cell may go on in the next batch
            same = (key == key[-1]) & (a == a[-1]) & (b == b[-1])
            cut = len(key) - int(same.sum())
            if cut:
                yield emit(tuple(c[:cut] for c in cols))
            held = [tuple(c[cut:] for c in cols)]
        if held and len(held[0][0]):
            yield emit(held[0])

    return run


def link_fingerprints(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) between the distinct fingerprints nodes.fp that connect all pairs within max_bits."""
    post = _postings(nodes, max_bits)
    hot = reliable_checkpoint(post.groupBy("key").count().where(F.col("count") > CELL).select("key", F.ceil(F.col("count") / CELL).cast("int").alias("chunks")))
    dealt = post.join(hot, "key", "left").select("key", "fp", F.coalesce("chunks", F.lit(1)).alias("chunks"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    cells = dealt.select("key", "fp", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    cells = cells.select("key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "fp")
    cells = cells.repartition(partitions(nodes.sparkSession), "key", "a", "b").sortWithinPartitions("key", "a", "b")
    return cells.mapInArrow(_compare(max_bits), "u long, v long")


def groups(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that names the group), component_id (smallest doc_id that links reach) of every document."""
    if not 0 <= max_bits <= 5:
        raise ValueError("the index covers bit distances from 0 to 5")
    docs_fp = reliable_checkpoint(fingerprints(docs, shingle))
    nodes = reliable_checkpoint(docs_fp.groupBy("fp").agg(F.min("doc_id").alias("low")))
    reached = connected_components(link_fingerprints(nodes.select("fp"), max_bits))
    rooted = nodes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = reliable_checkpoint(rooted.join(low, "root").select("fp", "root", "component_id"))
    return docs_fp.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def report(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    g = groups(docs, shingle, max_bits)
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents, one of each group: that with the smallest doc_id, of repeated rows just one; same columns."""
    g = groups(docs, shingle, max_bits)
    first = g.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("x"))
    key = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    chosen = first.select(key(F.col("x.doc_id")).alias("__sh_id"), F.col("x.text_hash").alias("__sh_th")).distinct()
    d = docs.withColumns({"__sh_id": key(F.col("doc_id")), "__sh_th": F.xxhash64("text")})
    return d.join(chosen, ["__sh_id", "__sh_th"]).dropDuplicates(["__sh_id", "__sh_th"]).select(*docs.columns)
