"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output.

Features of a text: its words and, inside every word with a mark at each end,
its character n-grams of NGRAMS code points, hashed to 2 ** BITS buckets, each
occurrence counted, a mark for each word that repeats the word before it, and
one end mark that every text has.  Every bucket has a
learned vector; a document is the average of its features' vectors, and a
softmax over that average gives the probability of label 1.

Fit: a bounded sample of the labelled documents (SAMPLE_ROWS, documented) is
turned into features in the tasks; the driver receives bucket numbers and
counts (at most one entry per bucket and document), no text, and trains vectors
and output layer by numpy stochastic gradient descent, one document at a time.

Predict: the softmax of two classes depends on the difference of the two
outputs alone, and that is linear in the average, so every bucket's vector is
folded into one number; a document's score is the logistic function of the
average of its features' numbers.  The numbers are multiples of 2 ** -20 and
are summed exactly: equal texts get equal scores in whatever batch they are.

Defined results: a null text counts as empty; an empty or blank text has the end
mark alone and gets its score; a word of more than CHUNK characters counts as
several; a doc_id that is labelled both 0 and 1, and a null label or doc_id, is
not learned from; without labelled rows of both labels every score is the
labels' share (0.5 without any); repeated rows get equal scores; an empty table
gives an empty result.  Only doc_id and text are read, so other columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 17
DIM = 12
NGRAMS = (3, 4)
EPOCHS = 5
RATE = 0.5
SEED = 13
#: At most so many labelled documents are used to fit (drawn by a hash of doc_id and text).
SAMPLE_ROWS = 4000
#: Scores from here on predict label 1.
THRESHOLD = 0.7
#: Characters that are worked on at a time; bounds a task's memory.
CHUNK = 1 << 20
FIXED = float(1 << 20)
#: The two marks' buckets, behind the hashed ones.
REPEAT, END = 1 << BITS, (1 << BITS) + 1
# Odd 64-bit multipliers of the hash functions.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

_TABLES: dict[str, np.ndarray] = {}  # built once in each task


def _white() -> np.ndarray:
    """For every code point, if it is white space."""
    if "white" not in _TABLES:
        _TABLES["white"] = np.char.isspace(np.arange(0x110000, dtype=np.uint32).view("U1"))
        _TABLES["white"][0] = False  # numpy takes a lone NUL for an empty string
        _TABLES["place"] = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _TABLES["white"]


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(MULTIPLIERS[2])
    return h >> np.uint64(64 - BITS)


def features(cp: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (buckets, positions) of code points that begin and end with white space; a position lies inside the feature's word.

    starts: the white space before each text; the first word behind it repeats nothing.
    """
    white = _white()[cp]
    wide = np.where(white, 0, cp).astype(np.uint64)
    edge = np.flatnonzero(white[:-1] & ~white[1:]) + 1  # first character of each word
    if not len(edge):
        return
    # words: a sum of characters, each times a number of its place in the word
    begin = np.zeros(len(cp), dtype=np.int64)
    begin[edge] = edge
    place = np.arange(len(cp)) - np.maximum.accumulate(begin)
    weight = _TABLES["place"][place & 63] + (place >> 6).astype(np.uint64)
    word = np.add.reduceat(wide * weight, edge) * np.uint64(MULTIPLIERS[0])
    yield _bucket(word), edge
    again = np.r_[False, word[1:] == word[:-1]]
    first = np.searchsorted(edge, starts)
    again[first[first < len(edge)]] = False
    yield np.full(again.sum(), REPEAT, dtype=np.uint64), edge[again]
    # n-grams: windows that have white space at their ends only
    for n in NGRAMS:
        inside = ~white[1 : len(cp) - n + 2]
        for k in range(2, n - 1):
            inside = inside & ~white[k : len(cp) - n + 1 + k]
        at = np.flatnonzero(inside[: max(0, len(cp) - n + 1)])
        h = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            h = (h ^ wide[at + k]) * np.uint64(MULTIPLIERS[k & 1])
            h ^= h >> np.uint64(32)
        yield _bucket(h), at + 1


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about CHUNK characters, cut at white space where there is some."""
    at = 0
    while len(text) - at > CHUNK:
        part = text[at : at + CHUNK]
        cut = max(part.rfind(c) for c in " \n\t\r")
        cut = cut if cut > 0 else CHUNK
        yield part[:cut]
        at += cut
    yield text[at:]


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets in order and how often each occurs."""
    n = np.zeros(END + 1, dtype=np.int64)
    n[END] = 1
    for part in pieces(text or ""):
        for buckets, _ in features(_points(f" {part} "), np.zeros(1, np.int64)):
            n += np.bincount(buckets.astype(np.int64), minlength=len(n))
    found = np.flatnonzero(n)
    return found.astype(np.uint32), n[found].astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray  # float32[buckets and marks, DIM]
    output: np.ndarray  # float32[DIM, 2]
    prior: float  # the score where nothing could be learned; nan otherwise

    def numbers(self) -> np.ndarray:
        """Every bucket's part of the difference of the two outputs, in units of 1 / FIXED."""
        return np.rint(self.vectors.astype(np.float64) @ (self.output[:, 1] - self.output[:, 0]).astype(np.float64) * FIXED)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Stochastic gradient descent on the log loss, one document at a time, the rate falling to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (END + 1, DIM)).astype(np.float32)
    output = np.zeros((DIM, 2), dtype=np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(vectors, output, float(labels.mean()) if len(labels) else 0.5)
    step, steps = 0, epochs * len(docs)
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            buckets, n = docs[d]
            share = n / n.sum()
            hidden = share @ vectors[buckets]
            out = hidden @ output
            e = np.exp(out - out.max())
            wrong = -e / e.sum()
            wrong[labels[d]] += 1
            wrong *= rate * (1 - step / steps)
            back = output @ wrong
            output += np.outer(hidden, wrong)
            # the vectors' step is scaled by the squared length of the document's shares, so long documents teach as much as short ones
            vectors[buckets] += np.outer(share / np.dot(share, share), back) * 0.1
            step += 1
    return Model(vectors, output, float("nan"))


def held_out(doc_id: Column) -> Column:
    """True for the documents that are never learned from: crc32(doc_id as text) mod 4 = 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [counted(t.as_py()) for t in batch["text"]]
        cols = [batch["quality"], batch["drawn"], pa.array([b.tobytes() for b, _ in got], pa.binary()), pa.array([n.tobytes() for _, n in got], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["quality", "drawn", "buckets", "counts"])


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """quality, drawn, buckets, counts of at most `rows` labelled documents that are not held out.

    Labels are drawn by a hash of doc_id before they meet the documents, so the side that is broadcast has at most
    `rows` rows; documents that share a drawn doc_id are drawn again by a hash of their text.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = one.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
    one = one.orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(rows).select("doc_id", F.col("low").cast("int").alias("quality"))
    d = docs.select("doc_id", "text").join(F.broadcast(one), "doc_id")
    d = d.select("quality", F.xxhash64("doc_id", "text").alias("drawn"), "text")
    return d.mapInArrow(_featurise, "quality int, drawn long, buckets binary, counts binary").orderBy("drawn", "quality").limit(rows)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the sample; the driver holds its bucket numbers and counts, at most one entry per bucket and document."""
    got = sample(docs, labels, rows).collect()
    held = [(np.frombuffer(r["buckets"], np.uint32), np.frombuffer(r["counts"], np.float32)) for r in got]
    return train(held, np.array([r["quality"] for r in got], dtype=np.int64))


class Scorer:
    """Scores of texts by a model's folded numbers."""

    def __init__(self, numbers: np.ndarray, prior: float):
        self.numbers, self.prior = numbers, prior

    def _add(self, part: list[tuple[int, str]], total: np.ndarray, count: np.ndarray) -> None:
        """Add the features of texts (given with the rows they belong to) to the rows' totals and counts."""
        cp = _points(" " + " ".join(t for _, t in part) + " ")
        starts = np.cumsum([0, *(len(t) + 1 for _, t in part)])
        rows = np.array([i for i, _ in part])
        for buckets, at in features(cp, starts[:-1]):
            of = rows[np.searchsorted(starts, at, side="right") - 1]
            total += np.bincount(of, weights=self.numbers[buckets], minlength=len(total))
            count += np.bincount(of, minlength=len(total))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.prior == self.prior:
            return np.full(len(texts), self.prior)
        total, count = np.full(len(texts), self.numbers[END]), np.ones(len(texts), dtype=np.int64)
        part, chars = [], 0
        for i, text in enumerate(texts):
            for p in pieces(text or ""):
                if chars + len(p) > CHUNK:
                    self._add(part, total, count)
                    part, chars = [], 0
                part.append((i, p))
                chars += len(p) + 1
        if part:
            self._add(part, total, count)
        return 1 / (1 + np.exp(np.clip(-total / FIXED / count, -700, 700)))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with the column score (a column of docs with that name goes)."""
    keep = [c for c in docs.columns if c.lower() != "score"]
    d = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields) + ", score double"
    numbers, prior = model.numbers(), model.prior

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(numbers, prior)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scorer.scores(b[text].to_pylist()))], [*keep, "score"])

    return d.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from the threshold on) of every document, by a model fitted on the same tables."""
    p = predict(docs.select("doc_id", "text"), fit(docs, labels, rows))
    return p.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
