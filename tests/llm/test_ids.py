"""Ids beyond 2**53 stay exact where a batch holds a null id too, and null ids stay null."""

from __future__ import annotations

import collections

import public_tokenizers
import pytest

from tidegauge.llm import bpe, exact_dedup, hmm, packing, quality, simhash, simhash_similar, suffix_dedup, toxicity

BIG = (1 << 60) + 1
TEXT = " ".join(f"w{i}" for i in range(60))
ROWS = [(BIG, TEXT), (None, "x y z"), (BIG + 1, TEXT + " end"), (3, "")]
OPERATORS = {
    "packing": lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")),
    "bpe": lambda d: bpe.bpe_round_trip(d, public_tokenizers.path("byte_bpe_50k.json"), lexicon_words=5),
    "exact": exact_dedup.exact_dedup,
    "simhash": simhash.simhash_near_dedup,
    "suffix": suffix_dedup.suffix_dedup,
    "hmm": lambda d: hmm.lm_score(d, states=2),
    "quality": lambda d: quality.grade(d, quality.Grader()),
    "toxicity": lambda d: toxicity.score(d, toxicity.Lexicon()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_ids_stay_exact(spark, name):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)
    assert collections.Counter(r.doc_id for r in OPERATORS[name](docs).collect()) == collections.Counter(i for i, _ in ROWS)


def test_similar_rows_keep_their_ids(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.keep_id) for r in simhash_similar.similar_groups(docs).collect()} == {(BIG, BIG), (BIG + 1, BIG)}
