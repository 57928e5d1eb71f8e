"""The corpus pipeline against a brute-force version on a small table."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

import corpus_pipeline
from souk.llm import langid, mixing, pieces
from tests.llm.data import AWKWARD, SF, docs, empty_docs, oracle, table
from tests.llm.test_texts import brute_components, brute_fingerprint, brute_lines


def test_pipeline_against_brute_force(spark):
    d = table("documents")
    got = corpus_pipeline.run(spark, SF).collect()
    # language: nothing but texts without a letter goes
    d = d[[any(c.isalpha() for c in t) for t in d.text]].reset_index(drop=True)
    rows = list(d[["doc_id", "text"]].itertuples(index=False, name=None))
    dropped = {i: sha for i, _, _, sha in brute_lines(rows, 10)}
    import re
    from collections import Counter

    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    seen = Counter(k for _, t in rows for k in {key(x) for x in t.split("\n")})
    d["text"] = ["\n".join(x for x in t.split("\n") if not key(x) or seen[key(x)] < 10) for _, t in rows]
    assert all(hashlib.sha256(t.encode()).hexdigest() == dropped[i] for i, t in zip(d.doc_id, d.text))
    comp = brute_components(d.doc_id.tolist(), [brute_fingerprint(t, 3) for t in d.text], 3)
    d = d[[i == c for i, c in zip(d.doc_id, comp)]]
    plan = oracle(mixing.ORACLE, documents=d)
    size = dict(zip(plan.doc_id, plan["size"]))
    copies = {i: (t // s if s else None) for i, t, s in zip(plan.doc_id, plan.taken, plan["size"])}
    n = {}
    for r in got:
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
        assert r.round_trip
    for i, c in copies.items():
        assert c is None or n.get(i, 0) == c, (i, c, size[i])
    text = dict(zip(d.doc_id, d.text))
    spelled = pieces.Vocabulary.read().spelled
    for r in got:
        assert pieces.decode(r.ids, spelled) == text[r.doc_id]


@pytest.mark.parametrize("make", [lambda s: docs(s, AWKWARD), empty_docs])
def test_stages_on_awkward_tables(spark, make):
    d = make(spark)
    columns = d.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.columns == columns, name
        d = spark.createDataFrame(d.collect(), d.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).where("NOT round_trip").count() == 0


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert duckdb and langid
