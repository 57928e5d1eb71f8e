"""Cross-tokenizer alignment: which tokens of one vocabulary stand for which of another.

A text with a space in front is encoded by a byte-level BPE vocabulary (A); the
text alone by a piece vocabulary (B), which adds that space itself.  Both spell
the same bytes; an offset where tokens of both end is a shared cut.

Divide and conquer at shared cuts: an interval looks for a common end from its
middle token outwards, each candidate by bisection in the other side's ends,
and goes on with both halves; an interval without a cut is a leaf group.  All
tokens of a group are linked with each other.  A task divides thousands of
intervals side by side, each step one bisection for all of them.

The first cuts of a text are known without its tokens: no token of either
vocabulary crosses a space between two characters that are not white space (A
splits there before it merges, and no piece of B holds a space mark behind
another character, which is checked when it is read).  The parts between them
recur, so a task encodes and aligns every distinct part once and remembers it
(PARTS_KEPT); a text's groups are the chain of its parts' groups.

Counts: a pair's count is the number of documents that hold it linked.  Texts
are encoded once and their distinct pairs stored; the counts come back to them
by a broadcast of the frequent pairs - a pair is frequent if it makes up at
least 1 / FREQUENT of all (document, pair) rows, so there are at most FREQUENT
of them - and by a shuffle join for the rest, whose keys are rare by that rule.

Defined results: a null or empty text, and one whose tokens of A or B do not
spell the space and the text (a space mark in the text, say), has no tokens:
zeros, and an empty digest.  Very long texts and parts need memory in
proportion to their own length.  Rows are documents: repeated rows count each
and get equal results; a null doc_id is an id like any other.  Only doc_id and
text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.common import stored
from souk.session import reliable_checkpoint

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Where texts are cut first: a space between two characters that are not white space.
SPACE = re.compile(r" (?<=\S )(?=\S)")
#: Parts (and pairs of parts) a task remembers before it starts anew, parts encoded at a time, characters of a result batch.
PARTS_KEPT, PAIRS_KEPT = 100_000, 1_000_000
ENCODED = 4096
BATCH_CHARS = 250_000
#: Parts that the encoders get in one string.
LINE = 64
#: Groups with more links than this are linked by their distinct ids.
SMALL_GROUP = 64
#: At most so many pairs are broadcast.
FREQUENT = 100_000


def leaf_groups(a: np.ndarray, b: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """The finest groups of tokens whose byte ranges agree: rows (a0, a1, b0, b1) in order.

    a and b are all token ends, rising; the arguments behind them are the intervals to divide, each ending where a token
    of both sides ends.  All open intervals try one candidate at a time, together: the middle token's end, then the next
    ones on either side; a hit halves the interval, an interval without candidates left is a leaf.
    """
    done, open_ = [], np.stack([a0, a1, b0, b1], axis=1)
    tried = np.zeros(len(open_), np.int64)  # candidates of an interval that were looked up
    while len(open_):
        a0, a1, b0, b1 = open_.T
        last = a1 - a0 - 1  # the last token ends with the interval
        leaf = (tried >= last) | (b1 - b0 <= 1)
        done.append(open_[leaf])
        open_, tried, last = open_[~leaf], tried[~leaf], last[~leaf]
        a0, a1, b0, b1 = open_.T
        # candidates in the order middle, middle + 1, middle - 1, ...; an even number of them has one more on the right
        off = np.where(tried % 2 == 1, (tried + 1) // 2, -(tried // 2))
        at = a0 + (last - 1) // 2 + off
        i = np.searchsorted(b, a[at])
        hit = (i < b1 - 1) & (b[np.minimum(i, len(b) - 1)] == a[at])
        left = np.stack([a0, at + 1, b0, i + 1], axis=1)[hit]
        right = np.stack([at + 1, a1, i + 1, b1], axis=1)[hit]
        tried = np.concatenate([tried[~hit] + 1, np.zeros(2 * len(left), np.int64)])
        open_ = np.concatenate([open_[~hit], left, right])
    out = np.concatenate([np.empty((0, 4), np.int64), *done])
    return out[np.argsort(out[:, 0], kind="stable")]


@dataclass
class Vocabularies:
    """Both vocabularies' files, as read on the driver; what they hold travels to the tasks."""

    byte_bpe: str
    pieces: bytes

    @classmethod
    def read(cls, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> Vocabularies:
        import sentencepiece

        with open(byte_bpe, encoding="utf-8") as f, open(pieces, "rb") as g:
            out = cls(f.read(), g.read())
        m = sentencepiece.SentencePieceProcessor(model_proto=out.pieces)
        for i in range(m.get_piece_size()):
            if MARK in m.id_to_piece(i).lstrip(MARK):
                raise ValueError(f"piece {m.id_to_piece(i)!r} holds a space mark inside: texts cannot be cut at spaces")
        return out


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _spelled(tokens: list[bytes]) -> pa.Array:
    return pa.array(tokens, pa.large_binary())


def _taken(pool: pa.Array, at: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The pool's entries at `at` in one buffer, and their ends."""
    got = pool.take(pa.array(at))
    return memoryview(got.buffers()[2] or b"").cast("B"), np.frombuffer(got.buffers()[1], np.int64)[1 : len(at) + 1] if len(at) else np.empty(0, np.int64)


class Aligner:
    """Aligns parts of texts; remembers them."""

    def __init__(self, vocabularies: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(vocabularies.byte_bpe)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.pieces)
        value = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=False)
        said = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            said[i] = bytes(value[c] for c in t) if all(c in value for c in t) else b""
        self.bytes_a = _spelled(said)
        marked = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = _spelled([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(marked)])
        # what a token is in a list of groups: its id and a comma, or what stands behind the last one of its side
        self.listed = _spelled([f"{i}{end}".encode() for end in ",|;" for i in range(max(len(said), len(marked)))])
        self.ids = max(len(said), len(marked))
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.counts = np.empty((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.first = np.zeros(1, np.int64)  # where a part's pairs begin
        self.pair_a, self.pair_b, self.pair_n = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64)

    @staticmethod
    def _lines(parts: list[str]) -> list[str]:
        """Parts joined by spaces, LINE at a time: there the encoders cut them again.  Parts with white space at an end stand alone."""
        lines, held = [], []
        for p in parts:
            plain = not (p[0].isspace() or p[-1].isspace())
            if held and (not plain or len(held) == LINE):
                lines.append(" ".join(held))
                held = []
            if plain:
                held.append(p)
            else:
                lines.append(p)
        return [*lines, " ".join(held)] if held else lines

    def _encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, bytes, np.ndarray]]:
        """For A and B the ids, where each text's begin, what they spell and the tokens' ends in that."""
        out = []
        for got, pool in (([e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], self.bytes_a), (self.b.encode(texts, num_threads=1), self.bytes_b)):
            ids = np.fromiter(chain.from_iterable(got), np.int64)
            data, upto = _taken(pool, ids)
            out.append((ids, np.cumsum([0, *map(len, got)]), bytes(data[: upto[-1] if len(upto) else 0]), upto))
        return out

    def align(self, parts: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
        """Groups, counts (n_a, n_b, n_groups, n_links), and pairs (a, b, n) with the part that each is of, sorted by part; no groups if the tokens do not spell a part."""
        codes = [(" " + p).encode() for p in parts]
        raw, ends = b"".join(codes), np.cumsum([len(c) for c in codes])
        side = []
        for ids, _, said, upto in self._encode(self._lines(parts)):
            behind = np.searchsorted(upto, ends)  # the last token of each part
            if said == raw and np.array_equal(upto[behind], ends):
                side.append((ids, np.r_[0, behind + 1], upto))
        if len(side) < 2:  # a part is not spelled by its tokens: each alone, and go on with the others
            cuts, good = np.r_[0, ends].tolist(), np.ones(len(parts), bool)
            for ids, first, said, upto in self._encode(parts):
                at = np.r_[0, upto][first].tolist()
                good &= [said[x:y] == raw[v:w] for x, y, v, w in zip(at, at[1:], cuts, cuts[1:])]
            rest = np.flatnonzero(good)
            if len(rest) == len(parts):
                side = [(ids, first, upto) for ids, first, _, upto in self._encode(parts)]
            else:
                groups, counts, pairs, of = self.align([parts[i] for i in rest]) if len(rest) else ([], 0, np.empty((0, 3), np.int64), np.empty(0, np.int64))
                all_groups, all_counts = [None] * len(parts), np.zeros((len(parts), 4), np.int64)
                for i, g in zip(rest, groups):
                    all_groups[i] = g
                all_counts[rest] = counts
                return all_groups, all_counts, pairs, rest[of]
        (a, first_a, end_a), (b, first_b, end_b) = side
        leaves = leaf_groups(end_a, end_b, first_a[:-1], first_a[1:], first_b[:-1], first_b[1:])
        a0, a1, b0, b1 = leaves.T
        n_a, n_b = a1 - a0, b1 - b0
        of = np.searchsorted(first_a, a0, side="right") - 1
        counts = np.stack([np.diff(first_a), np.diff(first_b), np.bincount(of, minlength=len(parts)), np.bincount(of, weights=n_a * n_b, minlength=len(parts)).astype(np.int64)], axis=1)
        # the list of groups: every token and what stands behind it
        listed = np.empty(len(a) + len(b), np.int64)
        of_a, of_b = np.repeat(np.arange(len(leaves)), n_a), np.repeat(np.arange(len(leaves)), n_b)
        at_a, at_b = np.arange(len(a)) + b0[of_a], np.arange(len(b)) + a1[of_b]
        listed[at_a], listed[at_b] = a, b
        listed[at_a[a1 - 1]] += self.ids
        listed[at_b[b1 - 1]] += 2 * self.ids
        data, upto = _taken(self.listed, listed)
        cuts = np.r_[0, upto][first_a + first_b].tolist()
        text = bytes(data[: cuts[-1]]).decode()
        groups = [text[x : y - 1] for x, y in zip(cuts, cuts[1:])]
        # pairs: small groups all at once, large ones by their distinct ids
        small = n_a * n_b <= SMALL_GROUP
        times = np.where(small, n_a * n_b, 0)
        leaf = np.repeat(np.arange(len(leaves)), times)
        k = np.arange(len(leaf)) - np.repeat(np.cumsum(times) - times, times)
        pairs = [np.stack([a[a0[leaf] + k // n_b[leaf]], b[b0[leaf] + k % n_b[leaf]], np.ones(len(leaf), np.int64)], axis=1)]
        owner = [of[leaf]]
        for g in np.flatnonzero(~small):
            (x, n), (y, m) = np.unique(a[a0[g] : a1[g]], return_counts=True), np.unique(b[b0[g] : b1[g]], return_counts=True)
            pairs.append(np.stack([np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(n, m).ravel()], axis=1))
            owner.append(np.full(len(x) * len(y), of[g]))
        pairs, owner = np.concatenate(pairs), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return groups, counts, pairs[order], owner[order]

    def learn(self, parts: list[str]) -> None:
        """Encode and align parts that are not remembered yet."""
        if len(self.number) > PARTS_KEPT or len(self.pair_n) > PAIRS_KEPT:
            self._clear()
        new = [p for p in dict.fromkeys(parts) if p not in self.number]
        got = []
        for at in range(0, len(new), ENCODED):
            some = new[at : at + ENCODED]
            groups, counts, pairs, of = self.align(some)
            self.number.update(zip(some, range(len(self.groups), len(self.groups) + len(some))))
            self.groups += groups
            got.append((counts, np.bincount(of, minlength=len(some)), pairs))
        if got:
            self.counts = np.concatenate([self.counts, *(x[0] for x in got)])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate([x[1] for x in got]))])
            for i, name in enumerate(("pair_a", "pair_b", "pair_n")):
                held = getattr(self, name)
                setattr(self, name, np.concatenate([held, *(x[2][:, i].astype(held.dtype) for x in got)]))

    def text(self, parts: list[str]) -> tuple[tuple, str, tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
        """Counts, groups and distinct pairs of a text from its (remembered) parts; None if a part is not spelled by its tokens."""
        rows = [self.number[p] for p in parts]
        groups = [self.groups[r] for r in rows]
        if None in groups:
            return None
        used, times = np.unique(rows, return_counts=True)
        begin, many = self.first[used], self.first[used + 1] - self.first[used]
        upto = np.cumsum(many)
        at = np.repeat(begin - upto + many, many) + np.arange(upto[-1])
        a, b, n = self.pair_a[at], self.pair_b[at], self.pair_n[at] * np.repeat(times, many)
        key = a.astype(np.int64) << 32 | b
        order = np.argsort(key, kind="stable")
        key = key[order]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        pairs = a[order][head], b[order][head], np.add.reduceat(n[order], head)
        return tuple(times @ self.counts[used]), ";".join(groups), pairs


def _column(arrays: list[np.ndarray], kind: pa.DataType, dtype) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, dtype), *arrays]), kind))


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pair_a array<int>, pair_b array<int>, pair_n array<long>"


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """Per document its doc_id, counts, groups and distinct pairs.

    groups lists the groups in order as `a1,a2|b1;a3|b2,b3` (decimal ids); pair_a, pair_b and pair_n are the
    distinct linked id pairs and how many links each stands for.
    """
    vocabularies = Vocabularies.read(byte_bpe, pieces)
    names = ["doc_id", *(x.split()[0] for x in ALIGNED.split(", "))]
    nothing = (0, 0, 0, 0), "", (np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies)
        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = (np.flatnonzero(np.diff(upto // BATCH_CHARS)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                parts = [SPACE.split(t) if t else None for t in batch["text"].slice(lo, hi - lo).to_pylist()]
                aligner.learn([p for of in parts if of for p in of])
                got = [(aligner.text(p) if p else None) or nothing for p in parts]
                counts = np.array([x[0] for x in got], np.int64).reshape(-1, 4)
                cols = [batch["doc_id"].slice(lo, hi - lo), *(pa.array(counts[:, i]) for i in range(4)), pa.array([x[1] for x in got], pa.string())]
                cols += [_column([x[2][i] for x in got], kind, dtype) for i, kind, dtype in ((0, pa.int32(), np.int32), (1, pa.int32(), np.int32), (2, pa.int64(), np.int64))]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {ALIGNED}")


def links(aligned: DataFrame, *key: str) -> DataFrame:
    """One row per document (told by the columns key) and distinct pair: a, b and times, the links it stands for."""
    x = aligned.select(*key, F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("x"))
    return x.select(*key, F.col("x.pair_a").alias("a"), F.col("x.pair_b").alias("b"), F.col("x.pair_n").alias("times"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (documents that hold the pair linked) and best (no pair of a has a higher n)."""
    n = reliable_checkpoint(links(aligned).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    top = n.groupBy("a").agg(F.max("n").alias("top"))
    return n.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def report(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = align(docs, byte_bpe, pieces).withColumn("groups_sha256", digest).drop("groups")
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()))
    pairs = reliable_checkpoint(pair_counts(aligned))
    rows = pairs.agg(F.sum("n")).first()[0] or 0  # one number
    frequent = pairs.where(F.col("n") * FREQUENT >= rows)  # at most FREQUENT of them
    rare = pairs.where(F.col("n") * FREQUENT < rows)
    of_row = links(aligned, "row").join(F.broadcast(frequent), ["a", "b"], "left")
    sums = (F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    found = of_row.where(F.col("n").isNotNull()).groupBy("row").agg(*sums)
    rest = of_row.where(F.col("n").isNull()).select("row", "a", "b", "times").join(rare, ["a", "b"]).groupBy("row").agg(*sums)
    both = found.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = aligned.drop("pair_a", "pair_b", "pair_n").join(both, "row", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
