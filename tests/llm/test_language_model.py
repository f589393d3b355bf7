"""Scores of the automaton against probabilities computed word by word."""

import random
from zlib import crc32

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tourlens.llm import language_model
from tourlens.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.001"


def held_out(i):
    return crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores(spark, monkeypatch, order):
    # The blocks, buckets and lanes of the tasks are small enough to be many.
    rng = random.Random(order)
    texts = [" ".join(rng.choice(["a", "B", "b", "c", "dd", "é"]) for _ in range(rng.choice([0, 1, 2, 30, 700]))) for _ in range(60)]
    docs = list(enumerate(texts + [None, "", " \t ", "new words only"]))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(language_model, "BUCKET", 64)
    got = language_model.score(frame, F.col("doc_id") % 4 != 1, order=order, strength=3.0).collect()
    expected = brute.language_model(docs, lambda i: i % 4 == 1, order, 3.0)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3] and r.train == (r.doc_id % 4 != 1)
        assert (r.base_score, r.score) == pytest.approx(expected[r.doc_id][3:], rel=1e-9)


def test_probabilities_of_all_words_sum_to_one(spark):
    docs = [(0, "a b a c a b"), (1, "b a")]
    words = ["a", "b", "c", "unknown"]
    asked = [(2 + i, f"a b {w}") for i, w in enumerate(words)] + [(9, "a b")]
    frame = spark.createDataFrame(docs + asked, "doc_id long, text string")
    rows = {r.doc_id: r for r in language_model.score(frame, F.col("doc_id") < 2).collect()}
    ends = brute.language_model(docs + asked, lambda i: i > 1, 2, language_model.STRENGTH)
    assert all(rows[i].score == pytest.approx(ends[i][4]) for i in rows)
    model = brute.language_model(docs + [(5, "a b")], lambda i: i == 5, 2, 1.0)
    assert model[5][1] == 3


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{GIVEN}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute.language_model(docs, held_out, language_model.ORDER, language_model.STRENGTH)
    got = QUERIES["op13_lm_scores"](spark, GIVEN).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3] and r.held_out == held_out(r.doc_id)
        assert (r.base_score, r.score) == pytest.approx(expected[r.doc_id][3:], rel=1e-8, abs=1e-6)


def test_edges(spark):
    ddl = "doc_id long, text string, key string, train string, block string"
    rows = [(1, "a b", "x", "y", "z"), (1, "a b", "x", "y", "z"), (None, "a", "x", "y", "z"), (2, None, "x", "y", "z"), (3, "w " * 300_000, "x", "y", "z")]
    frame = spark.createDataFrame(rows, ddl)
    got = language_model.score(frame, F.col("doc_id") != 3).collect()
    assert sorted((r.doc_id or 0, r.train, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(0, False, 2, 2, 7), (1, True, 3, 3, 7), (1, True, 3, 3, 7), (2, True, 1, 1, 7), (3, False, 300_001, 1, 7)]
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert language_model.score(frame.limit(0), F.lit(True)).count() == 0
    untrained = language_model.score(frame, F.lit(False)).collect()
    assert {r.score / r.n_tokens for r in untrained} == {0.0} and {r.train_tokens for r in untrained} == {0}


def test_keys_are_kept():
    rng = np.random.default_rng(1)
    for keys in (np.array([0], np.uint64), np.array([2**64 - 1], np.uint64), np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64)), np.array([5, 2**63], np.uint64)):
        assert (language_model._keys_in(language_model._keys_out(keys)) == keys).all()
