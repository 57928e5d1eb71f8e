"""SentencePiece encoding and decoding with n-best segmentation.

The text is a lattice of vocabulary pieces.  A forward Viterbi pass gives every
position the best score of a path from the start; backward A* search from the
end uses those scores as exact heuristics and yields the segmentations best
first.  No piece of such a vocabulary holds a space mark after another
character (checked when the vocabulary is read), so the lattice of a text is
the chain of the lattices of its words: words are segmented once per task, and
the n best of a text combine the n best of the words whose second-best loss is
smallest: the A* paths of those words stand in the chain of the others' best
paths.

A space is the mark U+2581, one is put in front; a mark that is in the text
itself, and a character without a piece of its own, are spelled in byte pieces
(UTF-8) at UNKNOWN below the lowest score each.  Decoding reverses this
exactly, so decode(encode(text)) = text for every text.

Defined results: a null or empty text has no pieces, one segmentation of score
0 and decodes to the empty string; very long texts and words need memory in
proportion to their own length; fewer than n segmentations give a shorter list;
among equal scores the best has the longer last piece, the order of the rest is
that of the search.  Only doc_id
and text are read; repeated rows get equal results.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Stands for a mark of the text itself inside the lattice; no UTF-8 text holds it.
OWN_MARK = "\ud800"
UNKNOWN = 10.0
#: Words a task remembers before it starts anew, and characters a result batch covers.
WORDS_KEPT = 400_000
BATCH_CHARS = 2_000_000
#: Longer words are segmented one by one.
LONG_WORD = 48


@dataclass
class Vocabulary:
    pieces: dict[str, tuple[int, float]]
    bytes_: list[int]  # id of each byte piece
    spelled: list[bytes]  # what each id decodes to, marks as spaces
    unknown: float
    trie: dict = field(default_factory=dict, repr=False)

    @classmethod
    def read(cls, path: str = VOCABULARY) -> Vocabulary:
        """Read a model file on the driver; what it holds travels to the tasks."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, bytes_, spelled, lowest = {}, [0] * 256, [], 0.0
        for i in range(m.get_piece_size()):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                bytes_[int(p[3:5], 16)] = i
                spelled.append(bytes([int(p[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i):
                spelled.append(b"")
            else:
                if MARK in p.lstrip(MARK):
                    raise ValueError(f"piece {p!r} holds a space mark inside: words are not independent")
                pieces[p] = (i, m.get_score(i))
                spelled.append(p.replace(MARK, " ").encode())
                if len(p) == 1:
                    lowest = min(lowest, m.get_score(i))
        return cls(pieces, bytes_, spelled, lowest - UNKNOWN)

    def _trie(self) -> dict:
        if not self.trie:
            for p, entry in self.pieces.items():
                node = self.trie
                for c in p:
                    node = node.setdefault(c, {})
                node[""] = entry
        return self.trie

    def edges(self, word: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each position, the pieces that end there as (start, score, ids), longest first."""
        root, ending = self._trie(), [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            node, single = root, False
            for j in range(i, len(word)):
                node = node.get(word[j])
                if node is None:
                    break
                if "" in node:
                    single |= j == i
                    ending[j + 1].append((i, node[""][1], node[""][0:1]))
            if not single:
                raw = (MARK if word[i] == OWN_MARK else word[i]).encode("utf-8", "surrogatepass")
                ending[i + 1].append((i, self.unknown * len(raw), tuple(self.bytes_[b] for b in raw)))
        return ending


def forward(ending: list) -> tuple[list[float], list[int]]:
    """Viterbi: the best score of a path from the start to each position, and which of its edges ends it."""
    best, via = [0.0], [-1]
    for into in ending[1:]:
        score, at = -np.inf, -1
        for n, (start, s, _) in enumerate(into):
            if best[start] + s > score:
                score, at = best[start] + s, n
        best.append(score)
        via.append(at)
    return best, via


def n_best(ending: list, best: list[float], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """Backward A*: the n best segmentations, best first; the forward scores are exact heuristics."""
    out, count = [], 0
    heap = [(-best[-1], 0, len(best) - 1, 0.0, ())]
    while heap and len(out) < n:
        cost, _, at, done, path = heapq.heappop(heap)
        if at == 0:
            ids = []
            while path:
                ids.extend(path[0])
                path = path[1]
            out.append((-cost, tuple(ids)))
            continue
        for start, s, ids in ending[at]:
            count += 1
            heapq.heappush(heap, (-(best[start] + s + done), count, start, done + s, (ids, path)))
    return out


class _Lookup:
    """The vocabulary as an open-addressing table from the hash of a piece to its id, for arrays of hashes."""

    BITS = 18
    BASE = 0x9E3779B97F4A7C15  # fixed value: an odd 64-bit multiplier

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        self.longest = max(map(len, pieces), default=1)
        size, mask = 1 << max(self.BITS, len(pieces).bit_length() + 2), (1 << 64) - 1
        keys, self.ids, self.scores = [0] * size, np.full(size, -1, np.int32), np.full(size, -np.inf)
        self.shift, self.last = np.uint64(65 - size.bit_length()), size - 1
        for piece, (i, score) in pieces.items():
            h = 0
            for c in piece:
                h = (h * self.BASE + ord(c) + 1) & mask
            at = int((h * self.BASE & mask) >> int(self.shift))
            while keys[at]:
                at = (at + 1) & self.last
            keys[at], self.ids[at], self.scores[at] = h, i, score
        self.keys = np.array(keys, np.uint64)

    def step(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Hashes of substrings one character longer."""
        return h * np.uint64(self.BASE) + c + np.uint64(1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash, or of a free slot (id -1, score -inf)."""
        at = ((h * np.uint64(self.BASE)) >> self.shift).astype(np.int64)
        todo = np.flatnonzero((self.keys[at] != h) & (self.keys[at] != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.last
            key = self.keys[at[todo]]
            todo = todo[(key != h[todo]) & (key != 0)]
        return at


class _Words:
    """Best segmentation, score and loss of the second best of every word met, by the number of the word."""

    def __init__(self, vocabulary: Vocabulary, lookup: _Lookup):
        self.vocabulary, self.lookup = vocabulary, lookup
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.start, self.count, self.score, self.loss = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)
        self.ids = np.empty(0, np.int32)
        self.ranked: dict[str, list[tuple[float, np.ndarray]]] = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; new ones are segmented."""
        known = len(self.number)
        out = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        new = list(islice(self.number, known, None))
        if new:
            ids, start, count, score, loss = self._segment(new)
            self.start = np.concatenate([self.start, len(self.ids) + start])
            self.ids = np.concatenate([self.ids, ids])
            self.count, self.score, self.loss = (np.concatenate(x) for x in ((self.count, count), (self.score, score), (self.loss, loss)))
        return out

    def _segment(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Ids of new words; where each word's begin, their number, score and loss: words of equal length together, the rest one by one."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.cumsum(length) - length
        # a character without a piece: its one byte piece if it is ASCII, else the word goes alone
        code, where = np.unique(flat, return_inverse=True)
        alone = np.array([c > 127 and chr(c) not in self.vocabulary.pieces for c in code.tolist()], dtype=bool)[where]
        single = (length > LONG_WORD) | (np.add.reduceat(alone, at) > 0)
        ids, held = [], 0
        start, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        score, loss = np.zeros(len(words)), np.zeros(len(words))
        for n in np.unique(length[~single]):
            rows = np.flatnonzero((length == n) & ~single)
            for part in np.array_split(rows, -(-len(rows) * int(n) // 200_000)):
                got, count[part], score[part], loss[part] = self._together(flat[at[part][:, None] + np.arange(n)])
                start[part] = held + np.cumsum(count[part]) - count[part]
                ids.append(got)
                held += len(got)
        for r in np.flatnonzero(single).tolist():
            path, score[r], loss[r] = self._alone(words[r])
            start[r], count[r] = held, len(path)
            ids.append(np.array(path, np.int32))
            held += len(path)
        return np.concatenate(ids), start, count, score, loss

    def _together(self, chars: np.ndarray) -> tuple[np.ndarray, ...]:
        """Forward Viterbi over the rows of a matrix of characters, all at once."""
        m, n = chars.shape
        top = min(n, self.lookup.longest)
        best, second = np.full((n + 1, m), -np.inf), np.full((n + 1, m), -np.inf)
        via = np.zeros((n + 1, m), np.int8)
        best[0] = 0
        c = chars.T.astype(np.uint64)
        h, scores, ids = np.zeros((n, m), np.uint64), [], []
        for size in range(1, top + 1):
            h = self.lookup.step(h[: n - size + 1], c[size - 1 :])
            slot = self.lookup.find(h.ravel()).reshape(h.shape)
            scores.append(self.lookup.scores[slot])
            ids.append(self.lookup.ids[slot])
        none = ids[0] < 0
        scores[0][none] = self.vocabulary.unknown
        ids[0][none] = np.array(self.vocabulary.bytes_, np.int32)[c[none].astype(np.int64) & 255]
        for j in range(1, n + 1):
            for size in range(min(j, top), 0, -1):  # longest first: it stays where scores are equal
                got = best[j - size] + scores[size - 1][j - size]
                better = got > best[j]
                second[j] = np.where(better, best[j], np.maximum(second[j], got))
                best[j] = np.where(better, got, best[j])
                via[j][better] = size
        out = np.full((m, n), -1, np.int32)
        loss, where = np.full(m, np.inf), np.full(m, n)
        for k in range(n):
            live = np.flatnonzero(where > 0)
            if not len(live):
                break
            j = where[live]
            # the second-best path leaves the best one at the node where that costs least
            loss[live] = np.minimum(loss[live], best[j, live] - second[j, live])
            size = via[j, live].astype(np.int64)
            for s in np.unique(size):
                of = size == s
                out[live[of], n - 1 - k] = ids[s - 1][j[of] - s, live[of]]
            where[live] = j - size
        return out[out >= 0], (out >= 0).sum(axis=1), best[n], loss

    def _alone(self, word: str) -> tuple[list[int], float, float]:
        ending = self.vocabulary.edges(word)
        best, via = forward(ending)
        at, path, loss = len(word), [], np.inf
        while at:
            into = ending[at]
            if len(into) > 1:
                loss = min(loss, min(best[at] - best[u] - s for n, (u, s, _) in enumerate(into) if n != via[at]))
            at, _, ids = into[via[at]]
            path.append(ids)
        return [i for ids in reversed(path) for i in ids], best[-1], loss

    def ways(self, word: str, n: int) -> list[tuple[float, np.ndarray]]:
        """The n best segmentations of the word, the best of the chain first: what each loses against it, and its ids."""
        if word not in self.ranked:
            ending = self.vocabulary.edges(word)
            best, _ = forward(ending)
            at = self.number[word]
            first = self.ids[self.start[at] : self.start[at] + self.count[at]]
            found = [(max(0.0, best[-1] - s), np.array(ids, np.int32)) for s, ids in n_best(ending, best, n)]
            # where scores are equal, the search may meet the chain's path later or not at all
            self.ranked[word] = [(0.0, first), *(x for x in found if not np.array_equal(x[1], first))][:n]
        return self.ranked[word]


def words_of(text: str) -> list[str]:
    """The words of a text with their space marks; joined they are the text with a mark in front."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, OWN_MARK)
    parts = text.split(" ")
    if "" not in parts:
        return [MARK + p for p in parts]
    out, run = [], ""
    for p in parts:  # an empty part is one more space before the next word
        run += MARK
        if p:
            out.append(run + p)
            run = ""
    return out + [run] if run else out


class Encoder:
    """Encodes texts with the words met so far."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        self.n, self.vocabulary, self.lookup = n, vocabulary, _Lookup(vocabulary.pieces)
        self.table = _Words(vocabulary, self.lookup)
        self.spelled = pa.array(vocabulary.spelled, pa.binary())

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[float]], list[bool]]:
        """For the texts together: ids of the best segmentations and where each text's begin; scores of the n best; round trips."""
        return self.segmentations(texts)[:4]

    def segmentations(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[float]], list[bool], list[list[np.ndarray]]]:
        """As encode, and for each text the ids of its n best segmentations, best first."""
        if len(self.table.number) > WORDS_KEPT:
            self.table = _Words(self.vocabulary, self.lookup)
        t, words, ends = self.table, [], [0]
        for text in texts:
            words += words_of(text or "")
            ends.append(len(words))
        rows = t.numbers(words)
        if not len(rows):
            return np.empty(0, np.int32), np.zeros(len(ends), np.int64), [[0.0]] * len(texts), [not x for x in texts], [[np.empty(0, np.int32)]] * len(texts)
        count = t.count[rows]
        upto = np.r_[0, np.cumsum(count)]
        ids = t.ids[np.repeat(t.start[rows] - upto[:-1], count) + np.arange(upto[-1])]
        score, loss = t.score[rows], t.loss[rows]
        scores, ways = [], []
        for a, b in zip(ends, ends[1:]):
            # a segmentation: its loss, and the words that are not cut their best way, with the ids they get
            total, sums = float(score[a:b].sum()), [(0.0, ())]
            few = np.argpartition(loss[a:b], self.n - 1)[: self.n - 1] if b - a >= self.n > 1 else range(b - a if self.n > 1 else 0)
            for at in few:
                of_word = t.ways(words[a + at], self.n)
                sums = heapq.nsmallest(self.n, ((x + y, (*other, (int(a + at), of)) if k else other) for x, other in sums for k, (y, of) in enumerate(of_word)), key=itemgetter(0))
            scores.append([total - x for x, _ in sums])
            ways.append([self._splice(ids, upto, a, b, sorted(other, key=itemgetter(0))) for _, other in sums])
        starts = upto[np.array(ends)]
        said = self.spelled.take(pa.array(ids))
        data, offsets = memoryview(said.buffers()[2]), np.frombuffer(said.buffers()[1], np.int32)[said.offset : said.offset + len(ids) + 1]
        back = []
        for text, a, b in zip(texts, offsets[starts[:-1]].tolist(), offsets[starts[1:]].tolist()):
            back.append(bytes(data[a + 1 : b]) == (text or "").encode() and (b == a or data[a] == 32))
        return ids, starts, scores, back, ways

    @staticmethod
    def _splice(ids: np.ndarray, upto: np.ndarray, a: int, b: int, other: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """The ids of the words from a to b, those of other words in the place of theirs."""
        parts, at = [], upto[a]
        for word, of in other:
            parts += [ids[at : upto[word]], of]
            at = upto[word + 1]
        return np.concatenate([*parts, ids[at : upto[b]]]) if parts else ids[at : upto[b]]


def decode(ids, spelled: list[bytes]) -> str:
    """The text of ids: pieces joined, marks to spaces, the first one gone."""
    text = b"".join(map(spelled.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _nested(ways: list[list[np.ndarray]]) -> pa.ListArray:
    """A column of lists of lists of ids."""
    flat = [ids for of_text in ways for ids in of_text]
    values = pa.array(np.concatenate([np.empty(0, np.int32), *flat]), pa.int32())
    inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, flat)]).astype(np.int32)), values)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ways)]).astype(np.int32)), inner)


def encode(docs: DataFrame, n: int = 3, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids (best segmentation), n_pieces, scores (of the n best), round_trip (the ids decode to the text) and segmentations (ids of the n best) of every document."""
    vocab = Vocabulary.read(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocab, n)
        for batch in batches:
            chars = np.cumsum(pc.fill_null(pc.utf8_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(chars // BATCH_CHARS)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.slice(a, b - a)
                ids, starts, scores, back, ways = encoder.segmentations(part["text"].to_pylist())
                column = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids, pa.int32()))
                cols = [part["doc_id"], column, pa.array(np.diff(starts)), pa.array(scores, pa.list_(pa.float64())), pa.array(back, pa.bool_()), _nested(ways)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "n_pieces", "scores", "round_trip", "segmentations"])

    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_pieces long, scores array<double>, round_trip boolean, segmentations array<array<int>>"
    return docs.select("doc_id", "text").mapInArrow(run, out)


def decode_column(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and text from doc_id and ids."""
    spelled = Vocabulary.read(vocabulary).spelled

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode(x.as_py() or [], spelled) for x in b["ids"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")
