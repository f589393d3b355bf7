"""Periodic runs against a search period by period."""

import random

import brute
import numpy as np
import pytest

from tourlens.llm import runs
from tourlens.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.01"


def found(words):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return [tuple(r) for r in runs.runs_of(np.array([numbers[w] for w in words] + [-1]), len(words)).tolist()]


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_of_random_words(letters):
    rng = random.Random(letters)
    for _ in range(400):
        n = rng.choice([1, 4, 6, 30, 120, 300])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.choice([0, 1, 3])):
            a = rng.randrange(n)
            p = rng.randint(1, 1 + (n - a) // rng.randint(3, 9))
            for i in range(a, rng.randint(a, n)):
                words[i] = words[a + (i - a) % p]
        assert found(words) == brute.runs(words)


def test_long_regions_at_all_scales():
    for period in (1, 2, 3, 4, 7, 8, 9, 31, 64, 100, 777):
        pattern = list(range(period))
        words = ["x"] + pattern * 5 + ["y"] + pattern * 3 + ["z"]
        assert (1, 5 * period, period) in found(words) or period == 1
        assert found(words) == brute.runs(words)
    assert found([0] * 200_000) == [(0, 200_000, 1)]
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 3000:
        fibonacci, before = fibonacci + before, fibonacci
    assert found(fibonacci) == brute.runs(fibonacci)


def test_several_texts_do_not_meet(spark):
    texts = ["a a a", "a a a", "a b a b a b a b", "a b a b", None, "", " \t\x0b ", "x " * 50_000, "é\x1cz " * 6, "A a A a A a A a"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)] + [(None, "q q q q q q", "k"), (2, texts[2], "k")], "doc_id long, text string, runs string")
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        words = ["q"] * 6 if r.doc_id is None else [w.decode() for w in (texts[r.doc_id] or "").encode().split()]
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), brute.runs(words))
        assert r.collapsed == brute.collapsed(words, brute.runs(words))
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, GIVEN).collect()}
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for i, text in docs:
        words = brute.looped(i, [w.decode() for w in (text or "").encode().split()])
        own = brute.runs(words)
        r = got[i]
        assert r.n_runs == len(own)
        assert r.runs_sha256 == brute.sha("".join(f"{a},{n},{q}\n" for a, n, q in own))
        assert r.collapsed_sha256 == brute.sha(brute.collapsed(words, own))
        if own:
            best = min(own, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
