"""Source divergence, cross-tokenizer alignment and the quality classifier, held against SQL, brute force and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from souk.llm import alignment, divergence, queries, subword
from tests.llm.data import AWKWARD, SF, docs, empty_docs, oracle, sorted_rows, table

SF10 = "/root/testdata/sf0.01"

# --- source divergence ------------------------------------------------------


def brute_audit(rows, min_docs, top):
    """The contract, with Python's integers."""
    occurs, holds, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        occurs[lang, source].update(found)
        holds[lang].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in holds[lang].items() if n >= min_docs]

        def p(*which):
            c = sum((occurs[g] for g in which), Counter())
            n = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        mine, whole = p((lang, source)), p(*(g for g in groups if g[0] == lang))
        part = {"pair": [(sum(abs(mine[t] - q[t]) for t in kept), s) for x, s in groups if x == lang and s != source for q in [p((lang, s))]]}
        part["term"] = [(mine[t] - whole[t], t) for t in kept if occurs[lang, source][t] and mine[t] > whole[t]]
        for name, values in part.items():
            values.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, name, item, v, k) for k, (v, item) in enumerate(values, 1) if name == "pair" or k <= top]
    return sorted(out)


def test_divergence_against_sql(spark):
    got = queries.op11_source_divergence(spark, SF10).toPandas()
    want = oracle(divergence.ORACLE, SF10)
    assert sorted_rows(got) == sorted_rows(want[got.columns])
    assert set(got.part) == {"pair", "term"} and got.value.max() > 0


def many_sources(n=3000, seed=5):
    rng = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)] + ["Été", "ÜBER", "naïve"]
    src = [None, "", *(f"s{k}" for k in range(23))]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "de"]), rng.choice(src)) for k in range(n)]
    return rows + [(0, "only here", "xx", "one"), (0, "hot " * 900, "en", "s1"), (1, None, None, None), (1, "12 -- !", "en", "bare")]


@pytest.mark.parametrize(("group_block", "term_block"), [(9, 64), (64, 4096)])
def test_divergence_cells_against_brute_force(spark, group_block, term_block):
    rows = many_sources(400)
    got = divergence.audit(docs(spark, rows), 3, 5, group_block, term_block).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, 3, 5)


def test_divergence_of_a_hot_source_and_awkward_rows(spark):
    rows = AWKWARD + [(99, "Shared line of the hot source", "en", "hot")] * 200
    got = divergence.audit(docs(spark, rows), 2, 50).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, 2, 50)
    assert divergence.audit(empty_docs(spark)).collect() == []


def test_divergence_without_kept_terms(spark):
    rows = [(1, "a", "en", "x"), (2, "b", "en", "y")]
    got = divergence.audit(docs(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_cells_hold_bounded_slices(spark):
    """A slice goes to as many cells as there are group blocks, and no cell holds more than two blocks' rows of its terms."""
    d = docs(spark, many_sources())
    counts = divergence.term_counts(d)
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg({"docs": "sum", "times": "sum"}).withColumnsRenamed({"sum(docs)": "n", "sum(times)": "lang_count"}).drop("n")
    rows = counts.where("times > 0").withColumnRenamed("times", "count").join(kept, ["lang", "term"])
    g = divergence.groups(counts, kept, rows, 5, 16)
    # body and heads together: one per block of the lang's sources for each
    cells = divergence._cells(rows.join(g.select("lang", "source", "place", "block", "blocks"), ["lang", "source"]))
    blocks = {r.lang: r.blocks for r in g.select("lang", "blocks").distinct().collect()}
    before = {r.lang: r.n for r in rows.groupBy("lang").agg({"term": "count"}).withColumnRenamed("count(term)", "n").collect()}
    assert {r.lang: r.n for r in cells.groupBy("lang").agg({"term": "count"}).withColumnRenamed("count(term)", "n").collect()} == {x: n * blocks[x] for x, n in before.items()}
    assert max(blocks.values()) == 5
    assert cells.groupBy("lang", "i", "j", "term").count().agg({"count": "max"}).first()[0] <= 10


# --- alignment --------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers_():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)


def brute_groups(tokenizers_, text):
    """Groups of a whole text, encoded in one go: cut at the offsets that both sides' ends have; None without tokens."""
    a, b = tokenizers_
    if not text:
        return None
    code = alignment.byte_alphabet()
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
    said = [[bytes(code[c] for c in a.id_to_token(i)) for i in ids[0]]]
    said.append([bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]])
    if any(b"".join(s) != (" " + text).encode() for s in said):
        return None
    ends = [np.cumsum([len(x) for x in s]).tolist() for s in said]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, at = [], [0, 0]
    for c in cuts:
        to = [e.index(c) + 1 for e in ends]
        out.append(tuple(ids[k][at[k] : to[k]] for k in (0, 1)))
        at = to
    return ids, out


def brute_report(tokenizers_, rows):
    of, count = [], Counter()
    for i, text in rows:
        got = brute_groups(tokenizers_, text)
        links = [p for x, y in got[1] for p in product(x, y)] if got else []
        of.append((i, got, links))
        count.update(set(links))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for i, got, links in of:
        digest = hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in got[1]).encode()).hexdigest() if got else ""
        n = (len(got[0][0]), len(got[0][1]), len(got[1])) if got else (0, 0, 0)
        out.append((i, *n, len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), digest))
    return sorted(out, key=repr)


def random_ends(rng, n, total):
    return sorted(rng.sample(range(1, total), min(n, total - 1))) + [total]


def test_leaf_groups_are_the_cuts_of_both_sides():
    rng = random.Random(3)
    for _ in range(500):
        total = rng.randint(1, 60)
        a, b = random_ends(rng, rng.randint(0, 40), total), random_ends(rng, rng.randint(0, 40), total)
        cuts = sorted(set(a) & set(b))
        at, want = (0, 0), []
        for c in cuts:
            to = (a.index(c) + 1, b.index(c) + 1)
            want.append((at[0], to[0], at[1], to[1]))
            at = to
        assert one_interval(a, b) == want


def one_interval(a, b):
    whole = [np.array([x]) for x in (0, len(a), 0, len(b))]
    return [tuple(g) for g in alignment.leaf_groups(np.array(a), np.array(b), *whole).tolist()]


def test_leaf_groups_of_many_intervals():
    """Intervals are divided side by side; none sees another's cuts."""
    rng = random.Random(4)
    a, b, ends, want = [], [], [[0], [0]], []
    for _ in range(200):
        total = rng.randint(1, 30)
        mine = random_ends(rng, rng.randint(0, 20), total), random_ends(rng, rng.randint(0, 20), total)
        base = a[-1] if a else 0
        want += [(x + len(a), y + len(a), u + len(b), v + len(b)) for x, y, u, v in one_interval(*mine)]
        a, b = a + [base + x for x in mine[0]], b + [base + x for x in mine[1]]
        ends[0].append(len(a))
        ends[1].append(len(b))
    e, f = map(np.array, ends)
    got = alignment.leaf_groups(np.array(a), np.array(b), e[:-1], e[1:], f[:-1], f[1:])
    assert [tuple(g) for g in got.tolist()] == want


def test_leaf_groups_without_a_cut_and_with_all():
    n = 50_000
    assert one_interval(list(range(2, 2 * n + 1, 2)), [*range(1, 2 * n, 2), 2 * n]) == [(0, n, 0, n + 1)]
    assert one_interval(list(range(1, n + 1)), list(range(1, n + 1))) == [(k, k + 1, k, k + 1) for k in range(n)]


def test_alignment_query_against_brute_force(spark, tokenizers_):
    got = sorted((tuple(r) for r in queries.op12_tokenizer_alignment(spark, SF).collect()), key=repr)
    d = table("documents")
    assert got == brute_report(tokenizers_, list(zip(d.doc_id.tolist(), d.text)))


HARD = [
    "<|endoftext|> <s> </s> <unk> and <0x41> as plain text",
    "  two  leading,   three inside and trailing   ",
    " \n \n\t x \r\n\n y\n z \t   w　v\x1c u \x85 t",
    "mark ▁ inside",
    "ﬁ ½ é Å ​ ﻿ x",
    "漢字かな交じり文 🙂👩‍👩‍👧 ẞß",
    "\x00 nul \x00x",
    "a" * 3000,
    "ab1 " * 500 + "'s 't 'll it's IT'S",
    "\n",
    " ",
    "x ",
    "漢" * 400,
    "ԱԲԳ" * 300 + " " + "=-" * 500,
]


def test_alignment_of_hard_texts(spark, tokenizers_):
    rows = [(k % 9, t, "en", "s") for k, t in enumerate(HARD)] + [(7, HARD[2], "en", "s")] * 30 + AWKWARD
    got = sorted((tuple(r) for r in alignment.report(docs(spark, rows)).collect()), key=repr)
    assert got == brute_report(tokenizers_, [(r[0], r[1]) for r in rows])
    assert sum(g[1] == 0 for g in got) >= 3  # null, empty, mark


def test_alignment_without_memory_or_broadcast(spark, tokenizers_, monkeypatch):
    """The same result if tasks forget at once and hardly any pair counts as frequent."""
    for name, value in (("PARTS_KEPT", 0), ("ENCODED", 3), ("BATCH_CHARS", 50), ("SMALL_GROUP", 1), ("FREQUENT", 2)):
        monkeypatch.setattr(alignment, name, value)
    rows = [(k, t, "en", "s") for k, t in enumerate(HARD)] + AWKWARD
    got = sorted((tuple(r) for r in alignment.report(docs(spark, rows)).collect()), key=repr)
    assert got == brute_report(tokenizers_, [(r[0], r[1]) for r in rows])


def test_alignment_of_random_texts_cut_at_spaces(tokenizers_):
    """Parts encoded alone give the tokens of the whole text."""
    rng = random.Random(11)
    aligner = alignment.Aligner(alignment.Vocabularies.read())
    alphabet = list("ab Z9.'\n\t é漢") + ["  ", " the", "\r\n", " ", " '", "-"]
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 25)))
        parts = alignment.SPACE.split(text)
        aligner.learn(parts)
        got = aligner.text(parts)
        want = brute_groups(tokenizers_, text)
        assert (got is None) == (want is None), repr(text)
        if got:
            assert got[1] == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want[1]), repr(text)


def test_alignment_empty_table(spark):
    assert alignment.report(empty_docs(spark)).collect() == []


def test_aligned_pairs_are_the_links(spark):
    d = alignment.align(docs(spark, [(1, "Aligned tokenizers, tokenizers!", "en", "s")])).first()
    assert sum(d.pair_n) == d.n_links and len(set(zip(d.pair_a, d.pair_b))) == len(d.pair_a)
    assert sum(len(g.split("|")[0].split(",")) for g in d.groups.split(";")) == d.n_a


# --- quality ----------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op13_quality_classifier(spark, sf).toPandas()
    labels = table("labels", sf)
    assert len(got) == len(table("documents", sf))
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert ((got.score >= 0) & (got.score <= 1)).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    m = got[got.held_out].merge(labels, on="doc_id")
    assert (m.predicted == m.quality).mean() >= 0.98
    assert m[m.quality == 1].predicted.mean() >= 0.99 and m[m.quality == 0].predicted.mean() <= 0.08


def make_labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string")


def test_quality_learns_from_text_alone(spark):
    """Other columns, ids and held-out labels change no score."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    out = [i for i in range(400) if i not in ids]
    rng = random.Random(1)
    text = {i: " ".join(rng.choices(["good", "fine", "plain", "words"] if i % 2 else ["BAD!!", "JUNK$$", "sp@m"], k=20)) for i in range(400)}
    rows = [(i, text[i], "en", "s") for i in ids] + [(i, "good plain words", "en", "s") for i in out]
    labels = [(i, i % 2, 0, "z") for i in ids]
    plain = {r.doc_id: r.score for r in subword.classify(docs(spark, rows), make_labels(spark, labels)).collect()}
    other = [(i, t, "xx", f"q{i % 2}") for i, t, _, _ in rows]
    misled = labels + [(i, 0, 1, None) for i in out] + [(None, 1, 1, None), (ids[0], None, 0, None)]
    assert {r.doc_id: r.score for r in subword.classify(docs(spark, other), make_labels(spark, misled)).collect()} == plain
    assert all((plain[i] >= 0.7) == bool(i % 2) for i in ids) and len({plain[i] for i in out}) == 1


def test_quality_awkward_rows(spark):
    labels = make_labels(spark, [(1, 1, 0, "s"), (4, 0, 0, "s"), (6, 0, 0, "s"), (6, 1, 0, "s"), (8, 0, None, None), (9, 1, 0, "s")])
    got = subword.classify(docs(spark, AWKWARD), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.score)
    assert len(by[7]) == 1 and by[2] == by[3] == by[4]  # repeated rows; null, empty and blank texts
    assert by[1] == by[7] == by[None]  # the same text
    assert subword.classify(empty_docs(spark), labels).collect() == []
    none = subword.classify(docs(spark, AWKWARD), make_labels(spark, [])).collect()
    assert {r.score for r in none} == {0.5}
    one = subword.classify(docs(spark, AWKWARD), make_labels(spark, [(1, 1, 0, "s"), (9, 1, 0, "s")])).collect()
    assert {r.score for r in one} == {1.0}


def test_quality_sample_is_bounded(spark):
    """Neither many labels nor a doc_id with a third of all rows makes the sample larger."""
    rows = [(5 if i % 3 else i, f"text {i} of many", "en", "s") for i in range(300)]
    labels = make_labels(spark, [(i, i % 2, 0, "s") for i in range(300)] * 3)
    assert subword.sample(docs(spark, rows), labels, rows=40).count() <= 40


def split_features(text):
    """Buckets of a text, word by word."""
    n, last = Counter(), None
    for word in text.split():
        buckets, times = subword.counted(word)
        n.update(dict(zip(buckets.tolist(), times.astype(int).tolist())))
        n[subword.END] -= 1
        if word == last:
            n[subword.REPEAT] += 1
        last = word
    n[subword.END] += 1
    return {k: v for k, v in n.items() if v}


def test_features_are_words_and_their_ngrams():
    rng = random.Random(2)
    words = ["a", "ab", "the", "Été", "漢字", "long" * 40, "🙂", "x\x00y", "the"]
    for _ in range(100):
        text = "".join(w + rng.choice([" ", "\n", "  ", "\t", " "]) for w in rng.choices(words, k=rng.randint(0, 30)))
        buckets, n = subword.counted(text)
        assert dict(zip(buckets.tolist(), n.astype(int).tolist())) == split_features(text)
    # one word and its n-grams of three and four characters, marks at both ends included: <ab> has <ab, ab>, <ab>
    assert subword.counted("ab")[1].sum() == 1 + 1 + 2 + 1


def test_scores_do_not_depend_on_the_batch(monkeypatch):
    rng = np.random.default_rng(0)
    scorer = subword.Scorer(np.rint(rng.normal(size=subword.END + 1) * subword.FIXED), float("nan"))
    texts = ["the the cat", None, "", "sat on", "on the mat " * 50, " \n ", "the end"]
    alone = [scorer.scores([t])[0] for t in texts]
    assert scorer.scores(texts).tolist() == alone
    want = []
    for t in texts:
        f = split_features(t or "")
        want.append(1 / (1 + np.exp(-sum(scorer.numbers[k] * v for k, v in f.items()) / subword.FIXED / sum(f.values()))))
    assert np.allclose(alone, want, rtol=1e-12)
    monkeypatch.setattr(subword, "CHUNK", 12)
    short = [t for t in texts if not t or len(t) <= 12]
    assert scorer.scores(short).tolist() == [a for t, a in zip(texts, alone) if not t or len(t) <= 12]
    assert "".join(subword.pieces("word " * 40)) == "word " * 40
