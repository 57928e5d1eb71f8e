"""Operators on documents, held against SQL, brute force and round trips."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from souk.llm import langid, line_dedup, mixing, pieces, queries, simhash, suffix_dedup
from tests.llm.data import AWKWARD, SF, docs, empty_docs, oracle, sorted_rows, table


# --- line dedup -------------------------------------------------------------


def brute_lines(rows, min_docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup_against_sql(spark):
    got = queries.op8_line_dedup(spark, SF).toPandas()
    want = oracle(line_dedup.ORACLE)
    assert sorted_rows(got) == sorted_rows(want[got.columns])
    assert got.n_dropped.sum() > 0


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_awkward(spark, min_docs):
    d = docs(spark, AWKWARD)
    got = line_dedup.dedup_report(d, min_docs).toPandas()
    want = brute_lines([(r[0], r[1]) for r in AWKWARD], min_docs)
    ids = [None if x != x else int(x) for x in got.doc_id.astype(float)]
    assert sorted(zip(ids, got.n_lines, got.n_dropped, got.kept_sha256), key=repr) == sorted(want, key=repr)
    texts = line_dedup.drop_lines(d, min_docs)
    assert texts.columns == d.columns and texts.count() == len(AWKWARD)


def test_line_dedup_counts_equal_rows(spark):
    rows = [(1, "shared\nown")] * 12 + [(None, "Shared \nx")] * 2 + [(2, "rare\nrare")] * 9 + [(3, "rare"), (4, "few"), (4, "few")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_report(d).toPandas()
    ids = [None if x != x else int(x) for x in got.doc_id.astype(float)]
    assert sorted(zip(ids, got.n_lines, got.n_dropped, got.kept_sha256), key=repr) == sorted(brute_lines(rows, 10), key=repr)
    assert repr(sorted_rows(got)) == repr(sorted_rows(oracle(line_dedup.ORACLE, documents=d.toPandas())[got.columns]))  # a null id is a NaN here


def test_line_dedup_keeps_first(spark):
    d = docs(spark, [(2, "b\na\nb", None, None), (1, "a\nc", None, None), (3, "A\nc", None, None)])
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(d, 2, keep_first=True).collect()}
    assert got == {1: "a\nc", 2: "b\nb", 3: ""}


# --- language ---------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(r) == d.count()
    held = r[r.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.97
    assert r.score.between(0, 1).all()


def test_stage_keeps_what_the_filters_know(spark):
    """The reference text of each language stays; unknown scripts and texts without a letter go; nothing learned: letters stay."""
    english = [(i, f"the {w} of the house and the garden", "en", "a") for i, w in enumerate(["walls", "roof", "trees", "doors"] * 5)]
    odd = [(100, "\u0395\u03bb\u03bb\u03ac\u03b4\u03b1", None, None), (101, "12 34 !", None, None), (102, None, "en", None), (103, "the house", None, None), (103, "the house", None, None)]
    kept = langid.keep_identified(docs(spark, english + odd))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(20), 103, 103] and kept.columns == docs(spark, odd).columns
    unlabelled = docs(spark, [(i, t, None, s) for i, t, _, s in english[:2] + odd])
    assert sorted(r.doc_id for r in langid.keep_identified(unlabelled).collect()) == [0, 1, 100, 103, 103]


def test_language_awkward(spark):
    r = {(x.doc_id, x.lang_pred) for x in langid.identify(docs(spark, AWKWARD)).collect()}
    und = {i for i, p in r if p == "und"}
    assert {2, 3, 4, 5} <= und and not und & {1, 6, 7, 8, 9}
    assert langid.identify(empty_docs(spark)).count() == 0
    kept = langid.keep_identified(docs(spark, AWKWARD))
    # without a letter: 2, 3, 4, 5; held out, and no filter knows any of its trigrams: 6
    unknown = {x.doc_id for x in langid.identify(docs(spark, AWKWARD)).collect() if x.lang_pred != "und" and x.score == 0}
    assert kept.columns == docs(spark, AWKWARD).columns and unknown == {6}
    assert sorted(repr(x.doc_id) for x in kept.collect()) == sorted(repr(r[0]) for r in AWKWARD if r[0] not in {2, 3, 4, 5, 6})


def test_language_filter_counts_and_correction():
    grams = np.arange(1000, 3000, dtype=np.uint64) * np.uint64(977)
    members = np.zeros((2000, 10), bool)
    members[:500, 0] = members[500:, 9] = True
    m = langid.LangModel.build([f"l{i}" for i in range(10)], 0, grams, members)
    c = m.counts(grams)
    assert c[0] >= 500 and c[9] >= 1500 and (c[1:9] == 0).all() and (m.false_rate < 0.02).all()


# --- SimHash ----------------------------------------------------------------


def brute_fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(max(1, len(words) - n + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(ids)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= bits:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    low = {}
    for i in range(len(ids)):
        low.setdefault(find(i), []).append(ids[i])
    return [min((x for x in low[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_simhash_against_brute_force(spark):
    pdf = table("documents").sort_values("doc_id")
    got = queries.op7_simhash_dedup(spark, SF).toPandas().sort_values("doc_id")
    fps = [brute_fingerprint(t, 3) for t in pdf.text]
    assert [format(f, "016x") for f in fps] == got.fingerprint.tolist()
    assert brute_components(pdf.doc_id.tolist(), fps, 3) == got.component_id.tolist()


def test_simhash_awkward_and_keep_one(spark):
    d = docs(spark, AWKWARD)
    got = simhash.report(d).collect()
    want = brute_components([r[0] for r in AWKWARD], [brute_fingerprint(r[1], 3) for r in AWKWARD], 3)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(zip([r[0] for r in AWKWARD], want), key=repr)
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))
    assert simhash.report(empty_docs(spark)).count() == 0


def test_keep_one_of_each_group_of_null_and_repeated_ids(spark):
    rnd = random.Random(7)
    texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(40)) for _ in range(6)]
    assert all(bin(brute_fingerprint(a, 3) ^ brute_fingerprint(b, 3)).count("1") > 3 for a, b in itertools.combinations(texts, 2))
    a, b, c, d, e, f = texts
    rows = [(None, a), (None, b), (None, b), (None, c), (4, c), (5, d), (5, e), (6, e), (5, f)]
    kept = simhash.keep_one(docs(spark, [(i, t, "en", "x") for i, t in rows])).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, a), (None, b), (4, c), (5, d), (5, e), (5, f)], key=repr)


@pytest.mark.parametrize("bits", [1, 3, 5])
def test_simhash_index_finds_every_link(spark, monkeypatch, bits):
    rnd = random.Random(bits)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = sorted({b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) for b in base for _ in range(40)})
    monkeypatch.setattr(simhash, "CELL", 7)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), bits)
    parent = {x: x for x in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in got.collect():
        assert bin((r.u ^ r.v) & ((1 << 64) - 1)).count("1") <= bits
        a, b = find(r.u), find(r.v)
        parent[max(a, b)] = min(a, b)
    want = brute_components(signed, fps, bits)
    classes = {}
    for s, w in zip(signed, want):
        classes.setdefault(w, set()).add(find(s))
    assert all(len(c) == 1 for c in classes.values())


# --- mixing -----------------------------------------------------------------


def test_mixing_against_sql(spark):
    got = queries.op3_source_mixing(spark, SF).toPandas()
    want = oracle(mixing.ORACLE)
    assert sorted_rows(got) == sorted_rows(want[got.columns])
    assert (got.taken <= 3 * got["size"]).all()


def test_mixing_awkward(spark):
    d = docs(spark, AWKWARD)
    got = mixing.report(d).toPandas()
    assert len(got) == len(AWKWARD) and (got.taken <= 3 * got["size"]).all()
    again = mixing.report(d.repartition(5)).toPandas()
    assert repr(sorted_rows(got)) == repr(sorted_rows(again))  # a null id is a NaN here
    assert mixing.mixed_documents(d).columns == d.columns
    assert mixing.report(empty_docs(spark)).count() == 0


def test_splitting_tree_keeps_quotas_and_fills_shards(spark):
    q = spark.createDataFrame([([1, 2, 3], [1000, 30, 471])], "ks array<int>, quota array<bigint>")
    rows = mixing.splitting_tree(q, 7, 3).collect()
    assert np.array([r.quota for r in rows]).sum(axis=0).tolist() == [1000, 30, 471]
    assert len(rows) == 7 and all(abs(sum(r.quota) - 1501 / 7) <= 2 for r in rows) and all(min(r.quota) >= 0 for r in rows)


def test_hypergeometric_draw_has_its_mean_and_spread(spark):
    u = "((id + 0.5D) / 2000)"
    x = spark.range(2000).selectExpr(mixing._draw("40L", "100L", "25L", u) + " AS x").toPandas().x
    assert abs(x.mean() - 10) < 0.05 and abs(x.var() - 25 * 0.4 * 0.6 * 75 / 99) < 0.1


def test_mix_rows_are_disjoint_and_complete(spark):
    plan, rows, _ = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))
    p, r = plan.toPandas(), rows.toPandas()
    assert r.copies.sum() == (p.n * p.passes + p.extra).sum() and not r.duplicated(["k", "m", "epoch"]).any()


def brute_mix(rows):
    """Sorted (doc_id, size, taken) by going through each source's cut pass document by document; the gap left per source too."""
    by = {}
    for i, t, s in rows:
        m = hashlib.md5(f"1:{'null' if i is None else i}:{'n' if t is None else 't' + t}".encode()).hexdigest()
        by.setdefault(s, []).append((m, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), i))
    order = sorted(by, key=lambda s: (s is None, s or ""))
    size = {s: sum(x[1] for x in by[s]) for s in order}
    weight, capped = {s: j % 3 + 1 for j, s in enumerate(order)}, set()
    while True:
        free = [s for s in order if s not in capped]
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if level * weight[s] > 3 * size[s]}
        if not more:
            break
        capped |= more
    out, ends = [], {}
    for s in order:
        target = 3.0 * size[s] if s in capped else min(3.0 * size[s], level * weight[s])
        passes = min(3, int(target // size[s])) if size[s] else 0
        gap = target - passes * size[s] if passes < 3 else 0.0
        cut, docs_, took = gap > 0, sorted(by[s], key=lambda x: x[:2]), []
        for m, n, i in docs_:
            took.append(cut and n <= gap)
            gap -= n * took[-1]
        over = [(n, m, j) for j, (m, n, i) in enumerate(docs_) if cut and not took[j] and n - gap < gap]
        if over:
            took[min(over)[2]] = True
            gap -= min(over)[0]
        left = [n for j, (m, n, i) in enumerate(docs_) if cut and not took[j]]
        ends[s] = (abs(gap), min(left, default=None))
        out += [(i, n, n * (passes + e)) for (m, n, i), e in zip(docs_, took)]
    return sorted(out, key=repr), ends


def mix_rows():
    """Sources with one long document among short ones, a hot source, a third of ids null, repeated rows, an empty and a null text."""
    rnd = random.Random(4)
    text = lambda n: " ".join(rnd.choice("abcdefghij") for _ in range(n))
    rows = [(1000 * s + j, text(330 if j == 50 else 10), f"s{s:02d}") for s in range(12) for j in range(68)]
    rows += [(None if j % 3 else 50_000 + j, text(rnd.choice([1, 3, 40, 200])), "hot") for j in range(400)]
    rows += [(-7, "one two three four five", "copies")] * 301 + [(-8, text(60), "copies")] * 5
    return rows + [(None, None, None), (9, "", None), (9, "x y", None), (9, "x y", "s01")]


def test_mixing_ends_near_every_target(spark):
    rows = mix_rows()
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.report(d).collect()
    want, ends = brute_mix(rows)
    assert sorted(((r.doc_id, r["size"], r.taken) for r in got), key=repr) == want
    assert all(left is None or off < left for off, left in ends.values())
    assert max(off for s, (off, _) in ends.items() if s and s.startswith("s")) < 10
    sql = oracle(mixing.ORACLE, documents=d.toPandas().astype({"doc_id": "Int64"}))
    assert sorted(zip(sql["size"], sql.target, sql.taken)) == sorted((r["size"], r.target, r.taken) for r in got)
    mixed = Counter(r.text for r in mixing.mixed_documents(d).collect())
    fives = sum(r.taken for r in got if r.doc_id == -7)
    assert 5 * mixed["one two three four five"] == fives > 0
    assert sum(len(t.split()) * n for t, n in mixed.items() if t) == sum(r.taken for r in got)


def test_mixing_many_sources(spark):
    rows = [(i, "a b c d e"[: 1 + 2 * (i % 5)], f"host{i % 10_000:05d}") for i in range(30_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.report(d).collect()
    assert sorted(((r.doc_id, r["size"], r.taken) for r in got), key=repr) == brute_mix(rows)[0]


# --- pieces -----------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.read()


def test_pieces_round_trip(spark):
    r = queries.op6_sentencepiece(spark, SF)
    assert r.where("NOT round_trip").count() == 0 and r.count() == len(table("documents"))
    back = {x.doc_id: x.text for x in pieces.decode_column(r).collect()}
    assert back == dict(table("documents")[["doc_id", "text"]].itertuples(index=False, name=None))


def test_pieces_awkward(spark):
    r = pieces.encode(docs(spark, AWKWARD)).collect()
    assert len(r) == len(AWKWARD) and all(x.round_trip for x in r)
    empty = next(x for x in r if x.doc_id == 2)
    assert empty.ids == [] and empty.scores == [0.0]
    assert pieces.encode(empty_docs(spark)).count() == 0


def all_segmentations(vocabulary, word):
    ending, out = vocabulary.edges(word), []

    def walk(at, score):
        if not at:
            out.append(score)
        for start, s, _ in ending[at] if at else []:
            walk(start, score + s)

    walk(len(word), 0.0)
    return sorted(out, reverse=True)


def test_n_best_is_exact(vocabulary):
    e = pieces.Encoder(vocabulary, 4)
    for text in ("the", "of then", "ab cd ef", "Häus und 漢", "a\nb c", "\u2581x y"):
        words = pieces.words_of(text)
        want = sorted((sum(x) for x in itertools.product(*(all_segmentations(vocabulary, w)[:4] for w in words))), reverse=True)[:4]
        ids, _, scores, back = e.encode([text])
        assert scores[0] == want and back == [True] and pieces.decode(ids.tolist(), vocabulary.spelled) == text


def all_paths(vocabulary, text):
    """Score and ids of every segmentation of a text."""
    out = [(0.0, ())]
    for word in pieces.words_of(text):
        ending, ways = vocabulary.edges(word), []

        def walk(at, score, ids):
            if not at:
                ways.append((score, ids))
            for start, s, of in ending[at] if at else []:
                walk(start, score + s, of + ids)

        walk(len(word), 0.0, ())
        out = [(x + y, i + j) for x, i in out for y, j in ways]
    return out


def test_n_best_ids_against_brute_force(vocabulary, spark):
    texts = ["the", "of then", "the the", "ab cd ef", "H\u00e4us \u6f22", "a\nb c", "\u2581x y", "a", "", None]
    for n in (1, 2, 4, 9):
        got = pieces.Encoder(vocabulary, n).segmentations(texts)
        for text, scores, ways, start, end in zip(texts, got[2], got[4], got[1], got[1][1:]):
            every, ways = all_paths(vocabulary, text or ""), [tuple(w.tolist()) for w in ways]
            score = {ids: s for s, ids in every}
            assert len(set(ways)) == len(ways) and ways[0] == tuple(got[0][start:end].tolist())
            assert [score[w] for w in ways] == scores == sorted(score.values(), reverse=True)[:n]
            assert all(pieces.decode(w, vocabulary.spelled) == (text or "") for w in ways)
    for r in pieces.encode(docs(spark, AWKWARD)).collect():
        assert r.segmentations[0] == r.ids and len(r.segmentations) == len(r.scores)
        assert len({pieces.decode(w, vocabulary.spelled) for w in r.segmentations}) == 1


def test_words_together_and_alone_agree(vocabulary):
    rnd = random.Random(2)
    words = [pieces.MARK + "".join(rnd.choice("theandäß\n\tqzé漢") for _ in range(rnd.randint(0, 12))) for _ in range(800)]
    t = pieces._Words(vocabulary, pieces._Lookup(vocabulary.pieces))
    for w, k in zip(words, t.numbers(words)):
        ids, score, loss = t._alone(w)
        assert t.ids[t.start[k] : t.start[k] + t.count[k]].tolist() == ids and t.score[k] == score and t.loss[k] == loss


# --- suffix arrays ----------------------------------------------------------


def brute_spans(rows, length):
    seen = Counter(b[p : p + length] for _, t in rows for b in [(t or "").encode()] for p in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                cover[p : p + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((i, len(b), sum(cover), sum(1 for x in bytes(cover).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def made_texts():
    rnd = random.Random(1)
    parts = ["ab", "a", "x", "the ", "and ", "é", "漢", " "]
    make = lambda lo, hi: "".join(rnd.choice(parts) for _ in range(rnd.randint(lo, hi)))
    shared, rows = [make(20, 120) for _ in range(10)], []
    for i in range(120):
        rows.append((i, "".join(rnd.choice(shared)[rnd.randint(0, 10) :] if rnd.random() < 0.5 else make(5, 80) for _ in range(rnd.randint(0, 5)))))
    return rows + [(400, None), (401, ""), (402, "a" * 500), (403, "ab" * 300), (404, rows[5][1]), (404, rows[5][1]), (None, "x" * 30)]


@pytest.mark.parametrize("hot, cell, shard", [(50_000, 4096, 6000), (20, 15, 40)])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, hot, cell, shard):
    for name, value in (("HOT", hot), ("CELL", cell), ("SHARD", shard)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = made_texts()
    got = suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), 30, 8)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_spans(rows, 30)


def test_suffix_dedup_registered_query(spark):
    got = queries.op9_suffix_dedup(spark, SF)
    rows = list(table("documents")[["doc_id", "text"]].itertuples(index=False, name=None))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_spans(rows, 200)


def test_suffix_dedup_awkward(spark):
    got = suffix_dedup.report(docs(spark, AWKWARD), 20, 6)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_spans([(r[0], r[1]) for r in AWKWARD], 20)
    assert suffix_dedup.report(empty_docs(spark)).count() == 0


def test_suffix_dedup_many_equal_rows(spark):
    """Equal rows are one place in the search; what others share with them goes, and their own text as a whole."""
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    text, short = word(700), word(90)
    rows = [(1, text)] * 1500 + [(None, text[:300] + word(60))] * 2 + [(2, word(50) + text[200:450] + word(30)), (3, word(400)), (4, short), (4, short)]
    got = suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_spans(rows, 200)


def test_suffix_array_and_prefixes_by_brute_force():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 60))).encode() for _ in range(30)] + [b"\0\0\0\0", b"\0\0"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
    sa = suffix_dedup.suffix_array(data, ends)
    suffix = lambda i: bytes(data[i : ends[i]])
    assert sa.tolist() == sorted(range(len(data)), key=lambda i: (suffix(i), i))
    shared = suffix_dedup.common_prefixes(data, ends, sa, 20)
    for a, b in zip(sa, sa[1:]):
        x, y = suffix(a), suffix(b)
        want = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert shared[b] == want or (shared[b] >= 20 and want >= 20)
