"""The pipeline's stages, each on its own input, against brute force."""

from __future__ import annotations

import collections
import os

import brute
import compare
import pytest
import test_near_copies as test_near_copies_brute

import corpus_pipeline
from tidegauge.llm import queries, toxicity
from tidegauge.llm.common import materialise, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def stages(spark):
    """name: (input rows, output rows) of each stage."""
    docs = table(spark, SF, "documents")
    extra = docs.limit(1).selectExpr("cast(null as bigint) as doc_id", "cast(null as string) as text", "lang", "source", "n_chars")
    docs, out = docs.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        new = materialise(stage(spark, docs, SF), name)
        assert name == "packing" or new.columns == docs.columns
        out[name] = (docs.collect(), new.collect())
        docs = new
    return out


def test_toxicity_drops_what_it_rejects_and_nothing_else(spark, stages):
    before, after = stages["toxicity"]
    docs = table(spark, SF, "documents")
    lex = toxicity.fit(docs, table(spark, SF, "labels"))
    a = lex.automaton()
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if lex.score(lex.density(a, r.text or "")) < 0.5)
    assert len(before) - len(after) < len(before) / 4


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op8_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 50 and hit >= 0.95 * len(rows) and sum(r.predicted and not r.toxic for r in rows) <= 0.02 * len(rows)


def test_exact_copies(stages):
    before, after = stages["exact_dedup"]
    groups = collections.defaultdict(list)
    for r in before:
        groups[r.text or ""].append(r)
    want = [max(g, key=lambda r: (r.doc_id is not None, r.doc_id or 0)) for g in groups.values()]
    assert sorted(map(repr, after)) == sorted(map(repr, want))


def test_near_copies(stages):
    before, after = stages["simhash_near_dedup"]
    keep, _ = test_near_copies_brute.survivors([(r.doc_id, r.text) for r in before])
    assert sorted(map(repr, after)) == sorted(repr(before[i]) for i in keep)


def test_repeats_are_cut(stages):
    before, after = stages["suffix_dedup"]
    raw = [(r.doc_id, (r.text or "").encode()) for r in before]
    spans = brute.repeated_spans(raw)
    got = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for i, t in raw:
        kept, at = b"", 0
        for a, b in spans[i]:
            kept, at = kept + t[at:a], b
        text = (kept + t[at:]).decode("utf-8", "ignore")
        assert (got[i].text or "") == text and (not spans[i] or got[i].n_chars == len(text))


def test_packing_takes_every_document(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    total = collections.Counter()
    for r in after:
        total[r.sequence_id] += r.length
    assert max(total.values()) <= 2048


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.ORACLE_SQL[name]) == ""


def test_run_is_registered():
    import __spark_entry__ as entry

    assert {"pipeline", *queries.QUERIES} <= set(entry.queries()) and len([q for q in queries.QUERIES if q.startswith("op")]) == 10
