"""Language identification with language-bitmask n-gram filters.

Fit: character trigrams are counted per language over a bounded sample of the
labelled documents.  A language "contains" a trigram whose share of the
language's trigrams is at least MIN_SHARE and at least KEEP_RATIO of the
largest share it has in any language, so a language contains at most
1 / MIN_SHARE trigrams, whatever the corpus.  The trigrams enter a bit-sliced
Bloom filter: each cell holds one bit per language, and the AND of a trigram's
HASHES cells is the set of all languages that contain it.

Predict: every trigram of the whole text is looked up; popcounts per language
are corrected for the filter's false positives, (count - n * fp) / (1 - fp)
with fp = (share of cells with the language's bit) ** HASHES, and the largest
corrected count wins; the score is its share of all of them.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text when nothing could be learned (no labelled row).  A text with
letters but without a known trigram gets the most frequent learned language
with score 0.  Ties go to the language that is first by code point.  Other
columns of the documents do not matter; repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SHARE = 1e-4
KEEP_RATIO = 0.2
HASHES = 3
CELLS_PER_GRAM = 16
#: At most about so many labelled documents of each language are used to fit (hash-sampled by doc_id).
SAMPLE_PER_LANG = 4000
#: Characters that are worked on at a time; bounds a task's memory.
CHUNK = 1 << 20
# Odd 64-bit multipliers of the filter's hash functions.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


_TABLES: dict[str, np.ndarray] = {}  # built once in each task


def _letters() -> np.ndarray:
    """For every code point, if it is a letter."""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.char.isalpha(np.arange(0x110000, dtype=np.uint32).view("U1"))
    return _TABLES["letters"]


def _grams(text: str) -> tuple[np.ndarray, bool]:
    """Trigram codes of a text (three code points of 21 bits; what is not a letter counts as a space), and if it has a letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return np.empty(0, np.uint64), False
    c = np.zeros(len(cp) + 2, dtype=np.uint64)
    c[1:-1] = np.where(letter, cp, 32)
    c[0] = c[-1] = 32
    # keep a trigram if its middle is a letter: that drops runs of spaces
    return ((c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:])[letter], True


def _cells(grams: np.ndarray, n_cells: int) -> list[np.ndarray]:
    shift = np.uint64(64 - n_cells.bit_length() + 1)
    return [((grams ^ (grams >> np.uint64(31))) * np.uint64(m)) >> shift for m in MULTIPLIERS[:HASHES]]


@dataclass
class LangModel:
    langs: list[str]
    common: int  # index of the language with the most sampled documents
    planes: np.ndarray  # uint8[bytes of languages, cells]: bit l % 8 of byte l // 8 of a cell is language l
    false_rate: np.ndarray

    @classmethod
    def build(cls, langs: list[str], common: int, grams: np.ndarray, members: np.ndarray) -> LangModel:
        """members: bool[grams, languages]."""
        n_cells = 1 << max(10, int(np.ceil(np.log2(max(1, len(grams)) * CELLS_PER_GRAM))))
        packed = np.packbits(members, axis=1, bitorder="little")
        planes = np.zeros((packed.shape[1], n_cells), dtype=np.uint8)
        for cells in _cells(grams, n_cells):
            for b in range(packed.shape[1]):
                np.bitwise_or.at(planes[b], cells, packed[:, b])
        fill = np.array([((planes[i // 8] >> (i % 8)) & 1).mean() for i in range(len(langs))])
        return cls(langs, common, planes, fill**HASHES)

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Per language, the number of trigrams whose bitmask has it."""
        out = np.zeros(len(self.langs))
        cells = _cells(grams, self.planes.shape[1])
        for b in range(self.planes.shape[0]):
            mask = self.planes[b][cells[0]]
            for c in cells[1:]:
                mask &= self.planes[b][c]
            hist = np.bincount(mask, minlength=256)
            for i in range(8 * b, min(8 * b + 8, len(self.langs))):
                out[i] = hist[(np.arange(256) >> (i % 8)) & 1 == 1].sum()
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return "und", 0.0
        n, found, seen = 0, np.zeros(len(self.langs)), False
        for at in range(0, len(text), CHUNK):  # a piece overlaps the last by two characters
            grams, any_letter = _grams(text[max(0, at - 2) : at + CHUNK])
            seen |= any_letter
            n += len(grams)
            found += self.counts(grams)
        if not seen:
            return "und", 0.0
        true = np.clip((found - n * self.false_rate) / (1 - self.false_rate), 0, None)
        if not true.sum() > 0:
            return self.langs[self.common], 0.0
        best = int(np.argmax(true))
        return self.langs[best], float(true[best] / true.sum())


def held_out(doc_id: Column) -> Column:
    """True for the documents that are never learned from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    for batch in batches:
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            lang, text = lang.as_py(), text.as_py()
            for at in range(0, len(text), CHUNK):
                grams, _ = _grams(text[max(0, at - 2) : at + CHUNK])
                held.setdefault(lang, []).append(grams)
                size[lang] = size.get(lang, 0) + len(grams)
                if size[lang] > CHUNK:
                    yield emit(lang, held.pop(lang))
                    size[lang] = 0
        for lang, parts in held.items():
            yield emit(lang, parts)


def fit(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> LangModel:
    """Learn from the text and lang of the documents that are not held out.

    What reaches the driver is bounded: a row per language, and the trigrams
    above MIN_SHARE (at most 1 / MIN_SHARE per language).
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LangModel([], 0, np.zeros((1, 1024), np.uint8), np.zeros(0))
    langs = sorted(sizes)
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, sample_per_lang / sizes[lang]))))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    counts = drawn.select("lang", "text").mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = counts.join(F.broadcast(total), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= MIN_SHARE)
    table = frequent.toPandas()
    grams, row = np.unique(table["gram"].to_numpy(np.int64), return_inverse=True)
    shares = np.zeros((len(grams), len(langs)))
    shares[row, [langs.index(x) for x in table["lang"]]] = table["share"]
    members = (shares > 0) & (shares >= KEEP_RATIO * shares.max(axis=1, initial=0.0, keepdims=True))
    common = min(range(len(langs)), key=lambda i: (-sizes[langs[i]], langs[i]))
    return LangModel.build(langs, common, grams.astype(np.uint64), members)


def predict(docs: DataFrame, model: LangModel, text: str = "text") -> DataFrame:
    """docs with the columns lang_pred and score (columns of docs with such a name go)."""
    keep = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    d = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t.as_py()) for t in b[text]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], [*keep, "lang_pred", "score"])

    return d.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model fitted on the same table."""
    model = fit(docs)
    p = predict(docs.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "text"), model)
    return p.select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language can be told, by a model fitted on the same table; same columns.

    A document goes if it has no letter (``und``), or if the filters know none of its trigrams beyond what their false
    positives explain (score 0).  Where nothing could be learned the filters reject nothing: texts with a letter stay.
    """
    model = fit(docs)
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = [f"__li_{c}" for c in docs.columns]  # so that no column clashes with the result's
    text = named[docs.columns.index("text")]
    p = predict(docs.toDF(*named), model, text).where((F.col("lang_pred") != "und") & (F.col("score") > 0))
    return p.select(*(F.col(n).alias(c) for n, c in zip(named, docs.columns)))
