import itertools
import random

import pytest

from conftest import dicts

from tourlens import schemas
from tourlens.plans import boards, similarity
from tourlens.plans.similarity import most_similar, similar_to, top_similar, venue_similarity


def fact(frame, visits):
    return frame(schemas.FACT_CONCERT, [{"artist_name": a, "venue_name": v} for a, v in visits])


def brute_force(visits):
    venues = {}
    for a, v in visits:
        if a is not None and v and v.strip(" "):
            venues.setdefault(a, set()).add(v.strip(" "))
    for a, b in itertools.combinations(sorted(venues), 2):
        shared = venues[a] & venues[b]
        if shared:
            share = len(shared) / len(venues[a] | venues[b])
            yield a, b, len(shared), round(share, 4), "; ".join(sorted(shared))


def test_example(frame):
    visits = [("A", v) for v in ("v1", " v2 ", "v3", "v2")] + [("B", v) for v in ("v2", "v3", "v4")]
    visits += [("C", "v9"), (None, "v2"), ("D", "  "), ("D", None)]
    got = dicts(venue_similarity(fact(frame, visits)))
    assert got == [
        {"artist_a": "A", "artist_b": "B", "shared_venues": 2, "jaccard_similarity": 0.5, "shared_venues_detail": "v2; v3"}
    ]


def test_no_venues_give_a_typed_empty_frame(frame):
    got = venue_similarity(fact(frame, [("A", None)]))
    want = frame(schemas.ARTIST_SIMILARITY, []).schema
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want]
    assert got.count() == 0


def test_a_crowded_venue_equals_brute_force(frame):
    """A third of all rows at one venue, in blocks far smaller than its crowd."""
    rng = random.Random(7)
    visits = [(f"a{i}", "hot") for i in range(60)]
    visits += [(f"a{rng.randrange(60)}", f"v{rng.randrange(25)}") for _ in range(120)]
    frames = fact(frame, visits)
    want = sorted(brute_force(visits))
    for block in (1000, 7):
        got = venue_similarity(frames, block_size=block)
        assert sorted((r.artist_a, r.artist_b, r.shared_venues, r.jaccard_similarity, r.shared_venues_detail) for r in got.collect()) == want
    for a, b, n, share, _ in want:
        assert a < b and 0 <= share <= 1 and n >= 1


def test_most_similar(frame):
    rows = [("A", "B", 3, 0.5), ("A", "C", 1, 0.7), ("B", "C", 1, 0.5), ("C", "D", 1, 0.1)]
    edges = frame(schemas.ARTIST_SIMILARITY, [dict(zip(("artist_a", "artist_b", "shared_venues", "jaccard_similarity"), r)) for r in rows])
    assert [r.similar_artist for r in similar_to(edges, "C").collect()] == ["A", "B", "D"]
    best = {(r.artist_name, r.similarity_rank): r.similar_artist for r in most_similar(edges, 2).collect()}
    assert best == {
        ("A", 1): "C", ("A", 2): "B", ("B", 1): "A", ("B", 2): "C", ("C", 1): "A", ("C", 2): "B", ("D", 1): "C",
    }
    assert [(r.artist_a, r.artist_b) for r in boards.top_pairs(edges, 2).collect()] == [("A", "C"), ("A", "B")]


def best(visits, k):
    """The best k of each artist by all pairs."""
    found = {}
    for a, b, n, share, _ in brute_force(visits):
        for x, y in ((a, b), (b, a)):
            found.setdefault(x, []).append((-share, y, n))
    return sorted((a, y, n, -share, i + 1) for a, rows in found.items() for i, (share, y, n) in enumerate(sorted(rows)[:k]))


def crowds(kind):
    rng = random.Random(kind)
    if kind == 0:
        return [(f"a{rng.randrange(60)}", f"v{rng.randrange(25)}") for _ in range(300)] + [(None, "v1"), ("a1", " "), ("z", None)]
    hot = [(f"a{i:03d}", "hot") for i in range(90)]
    if kind == 1:  # equal sets, and sets that share nothing but the crowd
        return hot + [(f"a{i:03d}", f"u{i}") for i in range(45)]
    return hot + [(f"a{i:03d}", f"c{i // 4}_{j}") for i in range(90) for j in range(rng.randrange(5))]


@pytest.mark.parametrize("kind", [0, 1, 2])
def test_top_similar_equals_all_pairs(frame, monkeypatch, kind):
    monkeypatch.setattr(similarity, "CLASSES", 2)
    monkeypatch.setattr(similarity, "MATCHES", 50)
    visits = crowds(kind)
    got = top_similar(fact(frame, visits), 3).collect()
    assert sorted(tuple(r) for r in got) == best(visits, 3)


def test_a_crowded_venue_opens_few_blocks(frame, monkeypatch):
    """Groups of four with venues of their own, all at one crowded venue: what only shares the crowd is not compared."""
    monkeypatch.setattr(similarity, "CLASSES", 3)
    visits = [(f"a{i:03d}", "hot") for i in range(400)] + [(f"a{i:03d}", f"c{i // 4}_{j % 5}") for i in range(400) for j in range(i % 4, i % 4 + 3)]
    opened = []
    kept = similarity._settled

    def counted(df, purpose):
        result = kept(df, purpose)
        if purpose == "similarity-open":
            opened.append(result.count())
        return result

    monkeypatch.setattr(similarity, "_settled", counted)
    got = top_similar(fact(frame, visits), 3)
    assert sorted(tuple(r) for r in got.collect()) == best(visits, 3)
    assert opened[0] <= 50 * 50 / 10  # of all pairs of the 50 blocks
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_no_artists(frame):
    assert top_similar(fact(frame, [("A", None)])).count() == 0
    assert top_similar(fact(frame, [("A", "v")])).count() == 0


@pytest.mark.parametrize("kind", [0, 1, 2])
@pytest.mark.parametrize("most", [0, 1000])
def test_both_ways_to_the_best_agree(frame, monkeypatch, kind, most):
    """By blocks, and by all that artists meet; crowded venues in many blocks."""
    monkeypatch.setattr(similarity, "CLASSES", 2)
    monkeypatch.setattr(similarity, "MET_PER_VISIT", most)
    monkeypatch.setattr(similarity, "ENTRIES", 100)
    made, kept = [], similarity._settled
    monkeypatch.setattr(similarity, "_settled", lambda df, purpose: made.append(purpose) or kept(df, purpose))
    visits = crowds(kind)
    got = top_similar(fact(frame, visits), 3).collect()
    assert sorted(tuple(r) for r in got) == best(visits, 3)
    assert ("similarity-blocks" in made) == (most == 0)


def test_lists_of_met_artists_are_shuffled_not_pairs(frame, monkeypatch):
    """A row per visit, and tasks by what is met."""
    monkeypatch.setattr(similarity, "ENTRIES", 40)
    rng = random.Random(3)
    visits = sorted({(f"a{rng.randrange(40)}", f"v{rng.randrange(30)}") for _ in range(200)})
    sets = similarity.venue_sets(fact(frame, visits))
    assert sorted(r.artist for r in sets.artists.collect()) == list(range(sets.artists.count()))
    rows = similarity.met(sets.visits)
    assert rows.count() <= len(visits)
    entries = similarity._entries(sets)
    assert sum(len(r.others) for r in rows.collect()) == entries
    assert similarity._gathered(rows, entries).rdd.getNumPartitions() == 1 + entries // 40
    edges = venue_similarity(fact(frame, visits), with_detail=False)
    text = edges._jdf.queryExecution().executedPlan().toString()
    assert ", other#" not in text.split("Exchange hashpartitioning(", 1)[1].split(")", 1)[0]
    assert sorted(tuple(r) for r in edges.collect()) == sorted(r[:4] for r in brute_force(visits))
