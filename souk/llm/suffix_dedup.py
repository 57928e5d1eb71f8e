"""Exact substring dedup with per-shard suffix arrays.

Every byte covered by a LENGTH-byte string that also starts elsewhere goes.

Sharding.  Of the GRAM-byte grams in a LENGTH-byte window the one with the least
hash (the leftmost of equals) is the window's anchor.  Equal windows have equal
anchors at equal offsets, so it is enough to compare windows that share an
anchor, each once.  The windows of one anchor occurrence form its context
(about 290 bytes).  Occurrences of one anchor with equal contexts repeat each
other in full; occurrences of an anchor that occurs once are unique; what is left
are contexts at the edges of repeated passages.  Only these and one
representative of each repeated context are sent, as text, to the shard of
their anchor.  An anchor with more than CELL of them is dealt over several
shards.

A shard lays its contexts out by document (overlapping ones are merged, so a
match in the shard is between different places of the corpus), builds the suffix
array by Larsson-Sadakane refinement (sort by a first few bytes, then double the
sorted length, each time sorting only groups that are still tied), takes common
prefixes by Kasai's recurrence, and marks every suffix that shares LENGTH bytes
with a neighbour.  Shards of a dealt anchor are merged: each hands on the hashes
of its distinct LENGTH-byte strings, which are range-partitioned, and binary search
finds those that are in more than one shard.

Equal rows: of a row that the table holds more than once every string repeats, so
its whole text goes by a count of rows; in the search it is one place, however
many copies there are (each batch of rows sends one of them).

Hot anchors: occurrences of an anchor with more than HOT of them are dealt by a
hash of the document; a context that is alone in its share is treated as an
edge, which is compared exactly later, so dealing cannot lose or add a match.
Tables of hot anchors are broadcast only while a count shows them small, and
joined else.

Defined results: a null or empty text has no bytes; nothing shorter than LENGTH
is removed; repeated rows are different documents that repeat each other (a row
is named by a 64-bit hash of doc_id and text); matches never cross
documents; other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import partitions, small, stored
from souk.session import reliable_checkpoint

LENGTH = 200
GRAM = 48
#: Bytes of text a task works on at a time, but at least one document.
BUFFER = 1 << 19
#: Occurrences from which an anchor is dealt by document; contexts a shard has of one anchor; contexts a shard has in all.
HOT = 50_000
CELL = 4096
SHARD = 3000
# Odd 64-bit multipliers of the hash functions.
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD)]
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _M[1]
    return (h ^ (h >> _U(29))) * _M[3]


class _Hashes:
    """Hashes of substrings of a buffer from prefix sums of byte * base ** position modulo 2 ** 64."""

    def __init__(self, data: np.ndarray, base: int = 0):
        n = len(data) + 1
        up, down = np.full(n, _M[base]), np.full(n, _U(pow(int(_M[base]), -1, 1 << 64)))
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        codes = _mix((np.arange(256, dtype=np.uint64) + _U(1)) * _M[2])
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(codes[data] * np.multiply.accumulate(up)[: n - 1], out=self.sums[1:])

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of data[a:b]."""
        return _mix((self.sums[b] - self.sums[a]) * self.down[a])

    def grams(self, size: int) -> np.ndarray:
        return _mix((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])


def _slide(a: np.ndarray, w: int, op: np.ufunc) -> np.ndarray:
    """op over every window of w values: block-wise running op from both sides."""
    n = len(a)
    pad = np.full(-(-n // w) * w, a[-1], a.dtype)
    pad[:n] = a
    ahead = op.accumulate(pad.reshape(-1, w), axis=1).ravel()
    behind = op.accumulate(pad.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[: n - w + 1], ahead[w - 1 : n])


def contexts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of the texts data[starts:ends]: text, anchor, context hash, and first and last window start of each context."""
    w = length - gram + 1
    fits = ends - starts >= length
    none = tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if not fits.any():
        return none
    h = _Hashes(data)
    grams = h.grams(gram)
    least = _slide(grams, w, np.minimum)
    step = np.zeros(len(data) + 1, np.int32)
    np.add.at(step, starts[fits], 1)
    np.add.at(step, ends[fits] - length + 1, -1)
    whole = np.cumsum(step[:-1])[: len(least)] > 0  # windows inside one text
    # grams that are the least of some window: candidates; a window's anchor is the first candidate in it that equals its least
    edge = np.zeros(w - 1, np.uint64)
    most = _slide(np.concatenate([edge, np.where(whole, least, _U(0)), edge]), w, np.maximum)[: len(grams)]
    candidates = np.flatnonzero((most == grams) & (most > 0))
    window = np.flatnonzero(whole)
    k = np.searchsorted(candidates, window)
    anchor, todo = np.empty(len(window), np.int64), np.arange(len(window))
    while len(todo):
        c = candidates[k[todo]]
        found = grams[c] == least[window[todo]]
        anchor[todo[found]] = c[found]
        todo = todo[~found]
        k[todo] += 1
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
    lo, hi, at = window[new], window[np.r_[new[1:], len(window)] - 1], anchor[new]
    context = _mix(h.between(lo, hi + length) ^ ((at - lo).astype(np.uint64) * _M[2]) ^ ((hi - lo).astype(np.uint64) * _M[0]))
    text = np.searchsorted(starts, lo, "right") - 1
    return text, grams[at], context, lo - starts[text], hi - starts[text]


def _key():
    return F.xxhash64("doc_id", "text")


def _once(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The first row of each key: rows equal in id and text are searched once (about: once per batch), see copies()."""
    _, first = np.unique(batch["key"].to_numpy(zero_copy_only=False), return_index=True)
    return batch if len(first) == len(batch) else batch.take(pa.array(np.sort(first)))


def copies(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, first, last: the whole text of documents of which there are several equal rows, if it has `length` bytes."""
    rows = docs.select(_key().alias("key"), F.xxhash64(F.lit("row"), "doc_id", "text").alias("key2"), F.octet_length("text").cast("long").alias("last"))
    several = rows.where(F.col("last") >= length).groupBy("key", "key2", "last").count().where(F.col("count") > 1)
    return several.select("key", F.lit(0).cast("long").alias("first"), "last")


def _occurrences(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(_once, batches):
            raw, keys = batch["raw"], batch["key"].to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            bin_of = np.cumsum(sizes) // BUFFER
            for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(bin_of)) + 1):
                data = np.frombuffer(b"".join(raw[int(i)].as_py() or b"" for i in part), np.uint8)
                ends = np.cumsum(sizes[part])
                keep = sizes[part] > 0
                if not keep.any():
                    continue
                text, anchor, context, lo, hi = contexts(data, (ends - sizes[part])[keep], ends[keep], length, gram)
                cols = [keys[part][keep][text], anchor.view(np.int64), context.view(np.int64), lo, (hi - lo).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "anchor", "context", "lo", "more"])

    return run


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by anchor, share, context: full repeats (kind 0), edge contexts (1) and representatives of repeats beside edges (2)."""

    def decide(cols: list[np.ndarray]) -> pa.RecordBatch:
        anchor, share, context, hot, key, lo, more = once(cols)
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (share[1:] != share[:-1])]
        first = new | np.r_[True, context[1:] != context[:-1]]
        run = np.cumsum(first) - 1
        alone = np.bincount(run)[run] == 1
        group = np.cumsum(new) - 1
        single = np.bincount(group)[group] == 1
        is_edge = alone & (~single | (hot > 0))
        has_edge = np.bincount(group, weights=is_edge)[group] > 0
        kinds = [(~alone, 0), (is_edge, 1), (~alone & first & (has_edge | (hot > 0)), 2)]
        at = np.concatenate([np.flatnonzero(m) for m, _ in kinds])
        kind = np.repeat(np.array([k for _, k in kinds], np.int32), [int(m.sum()) for m, _ in kinds])
        named = np.where(kind > 0, anchor[at], 0)
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(named), *(pa.array(c[at]) for c in (key, lo, more))], ["kind", "anchor", "key", "lo", "more"])

    def once(cols: list[np.ndarray]) -> list[np.ndarray]:
        """Rows sorted to the end, each place once: equal rows of the table are one place."""
        anchor, share, context, _, key, lo, _ = cols
        order = np.lexsort((lo, key, context, share, anchor))
        cols = [c[order] for c in cols]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in (cols[0], cols[1], cols[2], cols[4], cols[5]):
            new[1:] |= c[1:] != c[:-1]
        return [c[new] for c in cols]

    names, held = ("anchor", "share", "context", "hot", "key", "lo", "more"), None
    for batch in batches:
        cols = [batch[c].to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
        cut = len(last) - int(last.sum())  # rows are sorted: the last group may go on
        if cut:
            yield decide([c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield decide(held)


# --- a shard ---------------------------------------------------------------


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes data[i:ends[i]] in order (ends[i]: end of i's text; equal suffixes by position).

    Larsson-Sadakane refinement: positions carry the rank of their group; a
    group is sorted by the rank of the position behind its sorted prefix, and the
    sorted length doubles, until no two suffixes are tied.
    """
    n = len(data)
    where = np.arange(n)
    room = np.minimum(ends - where, 7)
    first = np.zeros(n, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for k in range(7):
        first = (first << _U(8)) | np.where(room > k, padded[k : k + n], 0).astype(np.uint64)
    first = (first << _U(8)) | room.astype(np.uint64)
    sa = np.argsort(first, kind="stable")
    sorted_ = first[sa]
    head = np.r_[True, sorted_[1:] != sorted_[:-1]]
    start = np.maximum.accumulate(np.where(head, where, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    size = np.diff(np.r_[np.flatnonzero(head), n])
    tied = np.flatnonzero(np.repeat(size, size) > 1)
    h = 7
    while len(tied):
        i = sa[tied]
        behind = i + h
        # what ends within the sorted prefix differs by position, below all others
        out = behind >= ends[i]
        second = np.where(out, i, n + rank[np.minimum(behind, n - 1)])
        order = np.lexsort((second, rank[i]))
        i, second, group = i[order], second[order], rank[i][order]
        sa[tied] = i
        head = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        rank[i] = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
        size = np.diff(np.r_[np.flatnonzero(head), len(tied)])
        tied = tied[np.repeat(size, size) > 1]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, ends: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """By position: bytes shared with the suffix before it in order, up to about `most`.

    Kasai's recurrence: the next position shares at least one byte less.  It runs
    along STRIDE positions for all strides of the shard at once, eight bytes at a time.
    """
    stride, n = 16, len(data)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    words = np.ndarray((n,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), 0, (1,)).copy()
    words = np.concatenate([words, np.zeros(1, np.uint64)])
    shared = np.zeros(n, np.int64)
    for s in range(stride):
        i = np.arange(s, n, stride)
        j = before[i]
        room = np.minimum(np.minimum(ends[i] - i, np.where(j < 0, 0, ends[j] - j)), most + stride)
        got = np.maximum(shared[i - 1] - 1, 0) if s else np.zeros(len(i), np.int64)
        todo = np.flatnonzero(got < room)
        while len(todo):
            p, q = i[todo] + got[todo], j[todo] + got[todo]
            x = words[np.minimum(p, n)] ^ words[np.minimum(q, n)]
            same = np.where(x == 0, 8, np.bitwise_count((x & (~x + _U(1))) - _U(1)) // 8)
            got[todo] += same
            todo = todo[(same == 8) & (got[todo] < room[todo])]
        shared[i] = np.minimum(got, room)
    return shared


def _layout(key: np.ndarray, lo: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Contexts merged by document and position: bytes, end of each byte's region, its document's row and place."""
    order = np.lexsort((lo, key))
    data, ends, rows, place = [], [], [], []
    size, at = 0, 0
    while at < len(order):
        r = order[at]
        region, begin, at = bytearray(parts[r]), int(lo[r]), at + 1
        while at < len(order) and key[order[at]] == key[r] and lo[order[at]] <= begin + len(region):
            o = order[at]
            region += parts[o][begin + len(region) - int(lo[o]) :] if int(lo[o]) + len(parts[o]) > begin + len(region) else b""
            at += 1
        data.append(bytes(region))
        size += len(region)
        ends.append(np.full(len(region), size))
        rows.append(np.full(len(region), r))
        place.append(np.arange(begin, begin + len(region)))
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(ends), np.concatenate(rows), np.concatenate(place)


def _spans(key: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Covered spans (key, first byte, byte after the last) of string starts in order."""
    if not len(key):
        return key, place, place
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (place[1:] != place[:-1] + 1)])
    return key[new], place[new], place[np.r_[new[1:], len(key)] - 1] + length


def search_shard(key: np.ndarray, lo: np.ndarray, parts: list[bytes], length: int, dealt: bool):
    """Spans repeated within the shard; if it is one of a dealt anchor, also a hash and place for each distinct string."""
    data, ends, rows, place = _layout(key, lo, parts)
    sa = suffix_array(data, ends)
    shared = common_prefixes(data, ends, sa, length)
    tie = shared[sa] >= length  # shares the string with the one before
    hit = np.zeros(len(data), bool)
    hit[sa[tie]] = True
    hit[sa[np.flatnonzero(tie) - 1]] = True
    at = np.flatnonzero(hit)
    spans = _spans(key[rows[at]], place[at], length)
    if not dealt:
        return spans, None
    one = sa[~tie]  # the first of each class
    one = one[ends[one] - one >= length]
    h = _Hashes(data).between(one, one + length)
    h2 = _Hashes(data, 2).between(one, one + length)
    return spans, (h.view(np.int64), h2.view(np.int64), key[rows[one]], place[one])


_OUT = "h long, h2 long, key long, first long, last long"


def _search(length: int):
    names = ["h", "h2", "key", "first", "last"]

    def result(found) -> Iterator[pa.RecordBatch]:
        (key, first, last), distinct = found
        none = pa.nulls(len(key), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, *(pa.array(c.astype(np.int64)) for c in (key, first, last))], names)
        if distinct is not None:
            h, h2, key, place = distinct
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (h, h2, key, place, place + length)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            bucket, anchor, dealt = (batch[c].to_numpy(zero_copy_only=False) for c in ("bucket", "cell", "dealt"))
            key, lo = batch["key"].to_numpy(zero_copy_only=False), batch["lo"].to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (anchor[1:] != anchor[:-1])])
            for a, b in zip(new, np.r_[new[1:], len(bucket)]):
                at = (bucket[a], anchor[a], bool(dealt[a]))
                if at != shard:
                    if held:
                        yield from result(search_shard(*(np.concatenate(c) for c in zip(*(h[:2] for h in held))), [x for h in held for x in h[2]], length, shard[2]))
                    shard, held = at, []
                held.append((key[a:b], lo[a:b], batch["part"].slice(a, b - a).to_pylist()))
        if held:
            yield from result(search_shard(*(np.concatenate(c) for c in zip(*(h[:2] for h in held))), [x for h in held for x in h[2]], length, shard[2]))

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of strings sorted by hash (each shard hands on each once): those that two shards hold, found by binary search."""
    held = None
    for batch in batches:
        cols = [batch[c].to_numpy(zero_copy_only=False) for c in ("h", "h2", "key", "first", "last")]
        cols = [np.concatenate(x) for x in zip(held, cols)] if held is not None else cols
        cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0  # the last hash may go on
        done, held = [c[:cut] for c in cols], [c[cut:] for c in cols]
        yield _common(done)
    if held is not None:
        yield _common(held)


def _common(cols: list[np.ndarray]) -> pa.RecordBatch:
    """The rows whose string is in the rows at two places (one place may be in the shards of two dealt anchors)."""
    h, h2, key, first, last = cols
    at = np.flatnonzero(np.searchsorted(h, h, "right") - np.searchsorted(h, h, "left") > 1)
    at = at[np.lexsort((first[at], key[at], h2[at], h[at]))]
    string = np.cumsum(np.r_[True, (h[at][1:] != h[at][:-1]) | (h2[at][1:] != h2[at][:-1])]) if len(at) else at
    place = np.r_[True, (string[1:] != string[:-1]) | (key[at][1:] != key[at][:-1]) | (first[at][1:] != first[at][:-1])] if len(at) else np.empty(0, bool)
    at = at[np.bincount(string, weights=place)[string] > 1] if len(at) else at
    return pa.RecordBatch.from_arrays([pa.array(c[at]) for c in (key, first, last)], ["key", "first", "last"])


# --- texts -----------------------------------------------------------------


def _pack(batches: Iterator[pa.RecordBatch], every: bool = True) -> Iterator[pa.RecordBatch]:
    """Texts compressed for their way through a shuffle: of every row, or of rows with one key only one in a batch."""
    z = zstandard.ZstdCompressor(level=1)
    for b in batches if every else map(_once, batches):
        for lo in range(0, len(b), 500):
            part = b.slice(lo, 500)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([z.compress(x.as_py() or b"") for x in part["raw"]], pa.binary())], [*part.schema.names[:-1], "packed"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the contexts asked for in each document."""
    z = zstandard.ZstdDecompressor()
    for b in batches:
        for lo in range(0, len(b), 200):
            out: list[list] = [[] for _ in range(6)]
            for key, packed, wanted in zip(*(b[c].slice(lo, 200) for c in ("key", "packed", "wanted"))):
                raw = z.decompress(packed.as_py())
                for w in wanted.as_py():
                    for c, x in zip(out, (w["bucket"], w["cell"], w["dealt"], key.as_py(), w["lo"], raw[w["lo"] : w["end"]])):
                        c.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["bucket", "cell", "dealt", "key", "lo", "part"])


def remove_spans(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of the text, and the number of maximal removed runs."""
    kept, at, runs = [], 0, 0
    for first, last in sorted(spans):
        if first > at or not runs:
            kept.append(raw[at:first])
            runs += 1
        at = max(at, last)
    kept.append(raw[at:])
    return b"".join(kept), runs


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdDecompressor()
    for b in batches:
        rows: list[list] = [[] for _ in range(4)]
        for packed, spans in zip(b["packed"], b["spans"]):
            raw = z.decompress(packed.as_py())
            kept, runs = remove_spans(raw, [(s["first"], s["last"]) for s in spans.as_py() or []])
            for c, x in zip(rows, (len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest())):
                c.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, k) for c, k in zip(rows, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """key (hash of doc_id and text), first, last: spans (overlapping ones included) whose strings of `length` bytes repeat."""
    spark = docs.sparkSession
    texts = docs.select(_key().alias("key"), F.col("text").cast("binary").alias("raw"))
    occ = texts.mapInArrow(_occurrences(length, gram), "key long, anchor long, context long, lo long, more int")
    hot = reliable_checkpoint(occ.groupBy("anchor").count().where(F.col("count") > HOT).select("anchor", F.ceil(F.col("count") / HOT).cast("int").alias("hot")))
    dealt = occ.join(small(hot), "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(0)))
    dealt = dealt.withColumn("share", F.when(F.col("hot") > 0, F.pmod(F.xxhash64("key"), F.greatest("hot", F.lit(1)))).otherwise(0).cast("int"))
    dealt = dealt.repartition(partitions(spark), "anchor", "share").sortWithinPartitions("anchor", "share", "context")
    dealt = dealt.select("anchor", "share", "context", "hot", "key", "lo", "more")
    judged = stored(dealt.mapInArrow(_judge, "kind int, anchor long, key long, lo long, more int"))
    full = judged.where(F.col("kind") == 0).select("key", F.col("lo").alias("first"), (F.col("lo") + F.col("more") + length).alias("last"))
    sent = judged.where(F.col("kind") > 0)
    buckets = max(1, -(-sent.count() // SHARD))
    large = reliable_checkpoint(sent.groupBy("anchor").count().where(F.col("count") > CELL).select("anchor", F.ceil(F.col("count") / CELL).alias("cells")))
    wanted = sent.join(small(large), "anchor", "left").select(
        "key",
        F.struct(
            F.when(F.col("cells").isNull(), F.pmod("anchor", F.lit(buckets))).otherwise(F.col("anchor")).alias("bucket"),
            F.when(F.col("cells").isNull(), F.lit(-1).cast("long")).otherwise(F.pmod(F.xxhash64("key"), F.col("cells"))).alias("cell"),
            F.col("cells").isNotNull().cast("int").alias("dealt"),
            F.col("lo"),
            (F.col("lo") + F.col("more") + length).alias("end"),
        ).alias("w"),
    )
    wanted = wanted.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    packed = texts.mapInArrow(lambda batches: _pack(batches, every=False), "key long, packed binary")
    parts = packed.join(wanted, "key").mapInArrow(_cut, "bucket long, cell long, dealt int, key long, lo long, part binary")
    parts = parts.repartition(max(partitions(spark), buckets // 4), "bucket", "cell").sortWithinPartitions("bucket", "cell", "dealt")
    found = stored(parts.mapInArrow(_search(length), _OUT))
    strings = found.where(F.col("h").isNotNull()).repartitionByRange(partitions(spark), "h").sortWithinPartitions("h")
    merged = strings.mapInArrow(_merge, "key long, first long, last long")
    return full.unionByName(found.where(F.col("h").isNull()).select("key", "first", "last")).unionByName(merged).unionByName(copies(docs, length))


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    spans = repeated_spans(docs, length, gram).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    packed = docs.select("doc_id", _key().alias("key"), F.col("text").cast("binary").alias("raw"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    packed = packed.mapInArrow(_pack, f"doc_id {id_type}, key long, packed binary")
    out = f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return packed.join(spans, "key", "left").select("doc_id", "packed", "spans").mapInArrow(_apply, out)
