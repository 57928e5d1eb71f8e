"""Operators on pages and embeddings, held against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest

from souk.llm import html_blocks, perm_index, pq_dedup, queries, url_rules
from souk.llm.components import connected_components
from tests.llm.data import SF, sorted_rows, table

# --- urls -------------------------------------------------------------------


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def brute_rule(host, path):
    fits = []
    for rule, verdict in url_rules.RULES:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/EN/x", "http://www.example.com/en/1?q#f", "https://a.example.com/en/2#x?y",
    "http://example.com", "http://example.com?x/en/", "ftp://net/es/5", "http://a.net/fr/7.html", "http://xnet/fr/", "http://Ünet/fr/", "x://y://z/a", "http://b.org/de/9/",
]


def test_url_parts_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[4]), (3, URLS[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS items", "'y' AS mined")
    labelled = spark.createDataFrame([], "url string, bad boolean")
    got = url_rules.judge(pages, labelled).collect()
    want = []
    for i, u in rows:
        h, p = brute_parts(u)
        rule, verdict = brute_rule(h, p)
        want.append((i, h, p, rule, verdict or "allow"))
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == sorted(want, key=repr)


def brute_rules(sets, min_support=url_rules.MIN_SUPPORT, min_confidence=url_rules.MIN_CONFIDENCE, min_count=url_rules.MIN_COUNT):
    """tokens -> (confidence, support) from (token set, bad)."""
    least = max(min_count, math.ceil(min_support * len(sets)))
    hits = Counter(c for s, bad in sets if bad for k in (1, 2, 3) for c in itertools.combinations(sorted(s), k))
    hits = {frozenset(c): n for c, n in hits.items() if n >= least}
    rules = {c: (n / sum(c <= s for s, _ in sets), n / len(sets)) for c, n in hits.items()}
    rules = {c: x for c, x in rules.items() if x[0] >= min_confidence}
    return {c: x for c, x in rules.items() if not any(o < c and rules[o][0] >= x[0] for o in rules)}


def token_sets(spark, urls):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i long, url string").select("i", url_rules.tokens(url_rules.F.col("url")).alias("items"))
    return [set(r["items"]) for r in sorted(rows.collect(), key=lambda r: r.i)]


def casino(rnd, n):
    rows = []
    for i in range(n):
        bad_host, promo = rnd.random() < 0.2, rnd.random() < 0.3
        url = f"http://{'casino' if bad_host else rnd.choice(['a', 'b', 'c'])}.site.org/{'promo' if promo else 'page'}/{i}"
        rows.append((url, (bad_host and promo) or rnd.random() < 0.05))
    return rows


def mined_rules(labelled, *args):
    return {frozenset(r.tokens): (r.confidence, r.support) for r in url_rules.mine(labelled, *args).collect()}


def test_mined_rules_by_brute_force(spark):
    rows = casino(random.Random(4), 400)
    labelled = spark.createDataFrame([*rows, ("http://q.org/", None)], "url string, bad boolean")
    sets = list(zip(token_sets(spark, [u for u, _ in rows]), [bad for _, bad in rows]))
    got = mined_rules(labelled, 0.02, 0.8)
    assert frozenset({"h:casino", "p:promo"}) in got and got == brute_rules(sets, 0.02, 0.8)
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, labelled).collect()}
    mined = brute_rules(sets)
    for i, (s, _) in enumerate(sets):
        assert verdicts[i] == ("block" if any(c <= s for c in mined) else "allow")


@pytest.mark.parametrize("copies", [1, 6])
def test_mining_of_urls_with_many_tokens(spark, copies):
    """One labelled url of 200 tokens, or several that share some of 24 frequent ones beside cleaner urls."""
    rnd = random.Random(copies)
    rows = casino(rnd, 50)
    rows += [(f"http://long.org/{'/'.join(f'w{j}' for j in range(200))}", True)]
    if copies > 1:
        words = [f"v{j}" for j in range(24)]
        rows += [(f"http://wide.org/{'/'.join(w for w in words if rnd.random() < 0.9)}", i % 4 > 0) for i in range(3 * copies)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    sets = list(zip(token_sets(spark, [u for u, _ in rows]), [bad for _, bad in rows]))
    assert max(len(s) for s, _ in sets) > 200
    sets = [({t for t in s if sum(t in o for o, _ in sets) >= url_rules.MIN_COUNT}, bad) for s, bad in sets]
    got = mined_rules(labelled)
    assert got == brute_rules(sets) and bool(got) == (copies > 1)


def test_url_query_covers_every_page(spark):
    got = queries.op1_url_filters(spark, SF).toPandas()
    pages, labels = table("pages"), table("labels")
    parts = {i: (*brute_parts(u), brute_rule(*brute_parts(u))) for i, u in pages[["page_id", "url"]].itertuples(index=False)}
    assert len(got) == len(pages)
    bad = {}
    for i, quality, toxic in labels[["doc_id", "quality", "toxic"]].itertuples(index=False):
        bad[i] = bad.get(i, False) or toxic == 1 or quality == 0
    sets = dict(zip(pages.page_id, token_sets(spark, pages.url)))
    numbers = {i: re.search(r"/([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", parts[i][1]) for i in pages.page_id}
    mined = brute_rules([(sets[i], bad[int(m[1])]) for i, m in numbers.items() if m and int(m[1]) in bad])
    for r in got.itertuples():
        h, p, (rule, verdict) = parts[r.page_id]
        assert (r.host, r.path) == (h, p) and (r.rule == rule or rule is None)
        assert r.verdict == (verdict or ("block" if any(c <= sets[r.page_id] for c in mined) else "allow"))


# --- html -------------------------------------------------------------------


@pytest.fixture(scope="module")
def tree():
    return html_blocks.grow(*html_blocks.labelled_table())


LONG = "Some words of a story that run on for long enough to be taken for a paragraph of text, and then some more."


def test_tree_fits_its_table(tree):
    x, y = html_blocks.labelled_table()
    assert [html_blocks.apply_tree(tree, r) for r in x] == y.tolist()


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("<", ""),
        ("<p", ""),
        (f"<article><p>{LONG}", LONG),
        (f"<article><h1>T &eacute;&#8212;&amp</h1><p><b>{LONG}<br><p>a  &lt;\n b</article><footer>{LONG}</footer>", f"T é—&\n{LONG}\na < b"),
        (f"<body><nav>{LONG}</nav><article><p>{LONG}</p><div class=comments><p>{LONG} {LONG}</p></div><p>end</p></article>", f"{LONG}\nend"),
        (f"<body><div class='ad'>{LONG}</div><main><p>{LONG}</p><form>{LONG}</form></main><aside>{LONG}</aside>", LONG),
        (f"<p>{LONG}<script>if(a<b){{'<p>no</p>'}}</script><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}", f"{LONG}\n{LONG}"),
        (f"<article><p>{LONG}</p></article><div id='cookie-notice'>{LONG}</div><section class='comments'><article class='comment'>{LONG}</article></section>", LONG),
    ],
)
def test_main_text(tree, page, want):
    assert html_blocks.main_text(page, tree) == want


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<script>a<b; // it's</script><article><p>It's {LONG}</p></article>", f"It's {LONG}"),
        (f"<style>a>b{{content:'<x'}} /* it's */</style><article><p>It's {LONG}</p></article>", f"It's {LONG}"),
        (f"<article><p title=it's>It's {LONG}</p><p>{LONG}</p></article>", f"It's {LONG}\n{LONG}"),
        (f"<article><p title='a > b' data-x=\"it's > this\">{LONG}</p><p a=b='c'>x</p></article>", f"{LONG}\nx"),
        (f"<article><p title='see class=comments id=ad'>{LONG}</p><p data-class=advert>x</p></article>", f"{LONG}\nx"),
        (f"<title>a <b it's</title><textarea>it's <p></textarea><article><p>{LONG}</article>", LONG),
        (f"<!-- it's <p> --><article><!--><p>{LONG}</p><!-- a > b --!></article>", LONG),
        (f"<body><article><p>{LONG}</p><p CLASS = 'advert'>no</p><p class=\n\"advert\">no</p><p hidden>no</p><p style='display: none'>no</p></article>", LONG),
    ],
)
def test_markup_is_read_to_its_end(tree, page, want):
    assert html_blocks.main_text(page, tree) == want


class _Reader(HTMLParser):
    """Start tags with their attributes, and text outside scripts and styles."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text = []

    def handle_data(self, data):
        if self.lasttag not in ("script", "style") or self.closed:
            self.text.append(data)

    def handle_starttag(self, tag, attrs):
        self.closed = False
        self.text.append(" ")

    def handle_endtag(self, tag):
        self.closed = True
        self.text.append(" ")


def test_words_agree_with_another_parser():
    """Random markup of text, attributes, scripts, styles and comments: the same words as the standard library's parser."""
    rnd = random.Random(7)
    inner = ["it's ", 'say "x" ', "a > b ", "word ", "one two ", "&amp; &eacute;t&#233; "]
    values = ["x", "it's", '"a > b"', "'c > d'", "\"it's\"", "'say \"x\"'", "a=b", "x/y"]
    for _ in range(300):
        page = []
        for _ in range(rnd.randrange(1, 12)):
            attrs = "".join(f" {rnd.choice(['title', 'data-x', 'alt'])}={rnd.choice(values)}" for _ in range(rnd.randrange(3)))
            said = "".join(rnd.choice(inner) for _ in range(rnd.randrange(3)))
            kind = rnd.choice(["p", "div", "b", "script", "style", "comment", "text"])
            if kind == "comment":
                page.append(f"<!-- {said}<p> -->")
            elif kind == "text":
                page.append(said)
            elif kind in ("script", "style"):
                page.append(f"<{kind}{attrs}>if (a<b) {{ '{said}<x' }}</{kind}>")
            else:
                page.append(f"<{kind}{attrs}>{said}</{kind} >")
        page = "".join(page)
        reader = _Reader()
        reader.feed(page)
        reader.close()
        assert " ".join(b.text for b in html_blocks.blocks(page)).split() == "".join(reader.text).split(), page


@pytest.mark.parametrize(
    "page",
    [
        "<article class='post category-reviews tag-popular'><h1>T</h1>{}<div class='ad box'>{}</div></article>",
        "<div class='content has-sidebar'><h1>T</h1>{}<div class='share-bar'>{}</div></div>",
        "<div class='page header-fixed'><article><h1>T</h1>{}<section class=comments>{}</section></article></div>",
        "<div class='page header-fixed'><div class=entry><h1>T</h1>{}</div><div class=sidebar>{}</div></div>",
        "<article class=review><h1>T</h1>{}</article><section class=reviews><article>{}</article></section>",
        "<div class='search tabs'><main><h1>T</h1>{}</main><aside>{}</aside></div>",
        "<div class=popular><article><h1>T</h1>{}</article></div><div class=comments>{}</div>",
    ],
)
def test_names_of_what_holds_the_article(tree, page):
    body = page.replace("{}", f"<p>{LONG}</p>", 1).replace("{}", f"<p>{LONG} {LONG}</p>")
    assert html_blocks.main_text(f"<nav><a href=a>x</a></nav>{body}<div class=site-footer>{LONG}</div>", tree) == f"T\n{LONG}"


def test_html_query(spark):
    got = queries.op2_html_extraction(spark, SF).toPandas()
    pages = table("pages")
    assert sorted(got.page_id) == sorted(pages.page_id) and (got.n_chars == got.text.str.len()).all()
    html = dict(pages[["page_id", "html"]].itertuples(index=False, name=None))
    for r in got.itertuples():
        article = html[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [b.text for b in html_blocks.blocks(article)]
        assert r.text == "\n".join(blocks)


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", f"<p>{LONG}", "y"), (1, None, None, "x")], "page_id long, url string, html string, text string")
    assert sorted_rows(html_blocks.extract(pages).toPandas()[["text", "n_chars"]]) == sorted([("", 0), ("", 0), (LONG, len(LONG))], key=repr)
    assert html_blocks.extract(pages.limit(0)).count() == 0


# --- vectors ----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, node string, v string"


def made_vectors(n=400, dim=12):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim))
    x[1::4] = x[::4] + 0.15 * rng.normal(size=x[::4].shape)
    x[2::4] = x[::4] * 3
    x[3] = x[0]
    return x.astype(np.float32).astype(float)


def frame(spark, x):
    rows = [(i, [float(c) for c in v], 0, "a", "b") for i, v in enumerate(x)]
    d = len(x[0])
    odd = [(9001, None, 0), (9002, [0.0] * d, 0), (9003, [float("nan")] * d, 0), (9004, [1.0] * (d - 1) + [None], 0), (9005, [float("inf")] + [1.0] * (d - 1), 0), (None, rows[0][1], 0), (9006, [], 0), (9020, [1.0, 2.0], 0)]
    return spark.createDataFrame(rows + [(*r, "a", "b") for r in odd], VECTORS), rows


def brute_links(x, t):
    n = np.sqrt((x * x).sum(axis=1))
    linked = (x @ x.T) / n[:, None] / n >= t
    np.fill_diagonal(linked, False)
    comp = np.arange(len(x))
    while True:
        new = np.array([min(comp[i], comp[linked[i]].min(initial=comp[i])) for i in range(len(x))])
        if (new == comp).all():
            return linked.sum(axis=1), comp
        comp = new


@pytest.mark.parametrize("chunk", [2048, 9])
def test_near_duplicates_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(pq_dedup, "CHUNK", chunk)
    monkeypatch.setattr(pq_dedup, "SLACK", 1.0)
    x = made_vectors()
    df, _ = frame(spark, x)
    got = {r.vec_id: r for r in pq_dedup.near_duplicates(df).collect()}
    n, comp = brute_links(np.r_[x, x[:1]], 0.9)  # the row without vec_id is the last
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n[i], comp[i], comp[i] == i)
    for i in (9001, 9002, 9003, 9004, 9005, 9006, 9020):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (n[-1], 0, False)
    assert pq_dedup.near_duplicates(df.limit(0)).count() == 0


def between_centres(seed=5):
    """Clusters 45 degrees apart, and vectors 24 to 25.5 degrees (cosine 0.902 to 0.914) from one towards another."""
    rng = np.random.default_rng(seed)
    k, dim = 12, 14
    centres = np.c_[np.full((k, 1), 2**-0.25), np.eye(k, dim - 1) * np.sqrt(1 - 2**-0.5)]
    tight = np.repeat(centres, 10, axis=0) + 1e-3 * rng.normal(size=(10 * k, dim))
    planted = []
    for i in range(k):
        for j in rng.choice(np.delete(np.arange(k), i), 4, replace=False):
            a, away = np.radians(rng.uniform(24, 25.5)), centres[j] - (centres[i] @ centres[j]) * centres[i]
            planted.append(np.cos(a) * centres[i] + np.sin(a) * away / np.sqrt(away @ away))
    return np.r_[tight, planted]


def test_links_along_the_line_between_centres(spark, monkeypatch):
    monkeypatch.setattr(pq_dedup, "CHUNK", 16)  # as many lists as clusters
    x = between_centres()
    got = {r.vec_id: r for r in pq_dedup.near_duplicates(frame(spark, x.astype(np.float32).astype(float))[0]).collect()}
    n, comp = brute_links(np.r_[x, x[:1]].astype(np.float32).astype(float), 0.9)  # the row without vec_id is the last
    assert [(got[i].n_links, got[i].component_id) for i in range(len(x))] == list(zip(n, comp))[:-1]


def test_near_duplicate_recall_on_the_table(spark):
    e = table("embeddings", "/root/testdata/sf0.1").sort_values("vec_id")
    x = np.array(e.embedding.tolist(), dtype=float)
    n, _ = brute_links(x, 0.9)
    got = queries.op4_embedding_dedup(spark, "/root/testdata/sf0.1").toPandas().sort_values("vec_id")
    assert (got.n_links.to_numpy() <= n).all() and got.n_links.sum() >= 0.99 * n.sum()


def brute_nearest(rows, at, k):
    """(score, vec_id) of the k rows nearest to row `at` of rows."""
    q = rows[at][1]
    scored = [(-float(np.dot(np.array(r[1]), np.array(q))), r[0] is None, r[0]) for i, r in enumerate(rows) if i != at and len(r[1]) == len(q)]
    return [(s, i) for s, _, i in sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(perm_index, "BLOCK", 150)
    monkeypatch.setattr(perm_index, "CHUNK", 7)
    x = made_vectors()
    df, rows = frame(spark, x)
    got = perm_index.search(df, 20, 20).collect()
    rows = [*rows, (None, rows[0][1])]
    order = lambda r: (-r.score, r.vec_id is None, r.vec_id or 0)
    hits = total = 0
    for q in range(0, len(x), 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and q not in [r.vec_id for r in mine]
        assert mine == sorted(mine, key=order)
        for r in mine:
            assert math.isclose(r.score, float(np.dot(x[r.vec_id or 0], x[q])), rel_tol=1e-12)
        want = brute_nearest(rows, q, 20)
        hits, total = hits + len({i for _, i in want} & {r.vec_id for r in mine}), total + 20
    assert hits / total >= 0.9
    assert None in [r.vec_id for r in got if r.query_id == 0]
    assert perm_index.search(df.limit(0)).count() == 0


def test_fewer_candidates_than_k(spark):
    d = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in perm_index.search(d).collect())
    assert got == [(0, 1, 3), (0, 2, 3), (0, 3, 20), (20, 1, 3), (20, 2, 3), (20, 3, 0)]


@pytest.mark.parametrize("block", [8, 8192])
def test_repeated_and_null_ids(spark, monkeypatch, block):
    """Rows that share vec_id, or have none, take part in both searches as rows of their own."""
    monkeypatch.setattr(perm_index, "BLOCK", block)
    monkeypatch.setattr(perm_index, "WIDTH", 1.0)
    rng = np.random.default_rng(8)
    v = [[float(c) for c in rng.integers(-3, 4, 6)] for _ in range(30)]
    v = [x if any(x) else [1.0] * 6 for x in v]
    ids = [20] * 25 + [None] * 30 + [7] * 6 + list(range(30, 60))
    rows = [(i, v[rng.integers(30)]) for i in ids] + [(20, v[0])] * 5 + [(None, v[1])] * 30 + [(40, v[1])] * 3
    d = spark.createDataFrame([(*r, "a") for r in rows], "vec_id long, embedding array<double>, n string").repartition(3)
    got = sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in perm_index.search(d, 20, 5).collect()), key=repr)
    want = [(r[0], k, i, -s) for at, r in enumerate(rows) if r[0] in (20, 40) for k, (s, i) in enumerate(brute_nearest(rows, at, 5), 1)]
    assert got == sorted(want, key=repr)
    n, comp = brute_links(np.array([r[1] for r in rows]), 0.9)
    low = {c: min((r[0] for r, k in zip(rows, comp) if k == c and r[0] is not None), default=None) for c in set(comp)}
    want = [(r[0], int(m), low[c], r[0] is not None and r[0] == low[c]) for r, m, c in zip(rows, n, comp)]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in pq_dedup.near_duplicates(d).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_nearest_neighbour_recall_on_the_table(spark):
    e = table("embeddings", "/root/testdata/sf0.1").sort_values("vec_id")
    x, ids = np.array(e.embedding.tolist(), dtype=float), e.vec_id.to_numpy()
    got = queries.op5_nearest_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    hits = 0
    queries_ = np.flatnonzero(ids % 20 == 0)
    for i in queries_:
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(set(ids[np.argsort(-s, kind="stable")[:20]]) & set(got[got.query_id == ids[i]].vec_id))
    assert hits / 20 / len(queries_) >= 0.9


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7), (None, 3)], "u long, v long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
