"""The registered queries over given tables, against plain Python."""

import html
import re
from collections import Counter
from zlib import crc32

import brute
import duckdb
import pytest

import corpus_pipeline
from tourlens.llm import decontaminate
from tourlens.llm.queries import ORACLES, QUERIES

GIVEN = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def rows_of(table, columns, folder=GIVEN):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{table}.parquet' ORDER BY 1").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{GIVEN}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, GIVEN).select(columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cursor.fetchall()))
    assert got


def test_main_texts(spark):
    expected = {}
    for i, source in rows_of("pages", "page_id, html"):
        inner = source.split("<article>")[1].split("</article>")[0]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("</?b>", "", b.replace("<br>", " ")))).strip() for b in re.split("</?(?:p|h1)>", inner)]
        expected[i] = "\n".join(b for b in blocks if b)
    got = QUERIES["op1_html_extraction"](spark, GIVEN).collect()
    assert {r.page_id: r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got)


def test_quality_on_held_out_labels(spark):
    quality = dict(rows_of("labels", "doc_id, quality", LARGER))
    got = QUERIES["op2_quality"](spark, LARGER).collect()
    assert len(got) == len(rows_of("documents", "doc_id", LARGER))
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in quality]
    assert sum(r.predicted == quality[r.doc_id] for r in held) / len(held) > 0.95


def test_exact_groups(spark):
    got = QUERIES["op3_exact_dedup"](spark, LARGER).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute.exact(rows_of("documents", "doc_id, text", LARGER))


def test_languages_of_held_out_documents(spark):
    language = dict(rows_of("documents", "doc_id, lang", LARGER))
    got = QUERIES["op4_language_id"](spark, LARGER).collect()
    assert len(got) == len(language)
    held = [r for r in got if r.held_out]
    assert all(crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.lang_pred == language[r.doc_id] for r in held) / len(held) > 0.95


def test_components(spark):
    got = QUERIES["op5_jaccard_join"](spark, LARGER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.linked(rows_of("documents", "doc_id, text", LARGER), 4, 85)


def test_contamination(spark):
    items = {i: re.sub(brute.SPACE, " ", t.lower()).strip() for i, t in rows_of("benchmark", "item_id, text", LARGER)}
    got = {r.doc_id: (r.contaminated, r.items, r.n_items) for r in QUERIES["op6_decontamination"](spark, LARGER).collect()}
    for i, text in rows_of("documents", "doc_id, text", LARGER):
        whole = re.sub(brute.SPACE, " ", text.lower())
        inside = sorted(k for k, t in items.items() if t in whole)
        assert got[i] == (bool(inside), inside, len(inside))  # no text here has a changed copy


def test_secrets(spark):
    got = {r.doc_id: r for r in QUERIES["op7_secrets"](spark, LARGER).collect()}
    kinds = ["assign", "access", "hex", "random"]
    added = 0
    for i, text in rows_of("documents", "doc_id, text", LARGER):
        spans, r = brute.secrets(text), got.pop(i)
        counts = Counter(k for k, _, _ in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(counts[k] for k in kinds[:3])
        base = brute.listed(spans, kinds)
        assert r.base_sha256 == brute.sha(base)
        more = [s for s in r.spans.split(",") if s.startswith("random")]
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("random")) == base
        added += len(more)
    assert not got and added <= 3  # the given texts hold no other secrets


def test_archives(spark):
    got = QUERIES["op8_warc"](spark, LARGER).collect()
    expected = brute.captures(rows_of("pages", "page_id, html", LARGER))
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == expected
    order = [(r.url_key, r.captured_at, r.page_id) for r in got]
    assert order == sorted(order)


def test_personal_data(spark):
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, LARGER).collect()}
    kinds = ["email", "ip", "card", "phone"]
    for i, text in rows_of("documents", "doc_id, text", LARGER):
        spans, r = brute.private(text), got.pop(i)
        counts = Counter(k for k, _, _ in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in kinds)
        base = brute.listed(spans, kinds)
        assert r.base_sha256 == brute.sha(base)
        assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in kinds) == base
    assert not got


def test_mix(spark):
    docs = rows_of("documents", "doc_id, text, source", LARGER)
    sizes = brute.source_sizes(docs)
    targets, source = brute.targets(sizes), {i: s for i, _, s in docs}
    got = QUERIES["op10_mixing"](spark, LARGER).collect()
    again = QUERIES["op10_mixing"](spark, LARGER).collect()
    assert sorted(got) == sorted(again) and len(got) == len(docs)
    taken, longest, text = Counter(), Counter(), {i: t for i, t, _ in docs}
    for r in got:
        s = source[r.doc_id]
        assert r.size == brute.words(text[r.doc_id]) and r.source_size == sizes[s] and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        assert r.target == pytest.approx(targets[s])
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= longest[s] / 2 + 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    text = dict(rows_of("documents", "doc_id, text", LARGER))
    lettered = {i for i, t in text.items() if t and re.search(r"[^\W\d_]", t)}
    kept = corpus_pipeline.STAGES[0][1](spark, docs, LARGER)
    assert kept.columns == docs.columns
    first = {r.doc_id for r in kept.select("doc_id").collect()}
    assert first <= lettered and len(first) > 0.99 * len(lettered)

    exact = corpus_pipeline.STAGES[1][1](spark, docs, LARGER)
    assert exact.columns == docs.columns
    groups = brute.exact(list(text.items()))
    second = {r.doc_id for r in exact.select("doc_id").collect()}
    assert second == {i for i, g in groups.items() if g[2]}

    near = corpus_pipeline.STAGES[2][1](spark, docs, LARGER)
    assert near.columns == docs.columns
    found = brute.linked(list(text.items()), 5, 80)
    assert {r.doc_id for r in near.select("doc_id").collect()} == {i for i, (_, c) in found.items() if c == i}

    clean = corpus_pipeline.STAGES[3][1](spark, docs, LARGER)
    assert clean.columns == docs.columns
    rows = decontaminate.contamination(docs, spark.read.parquet(f"{LARGER}/benchmark.parquet")).collect()
    assert sorted(r.doc_id for r in clean.select("doc_id").collect()) == sorted(r.doc_id for r in rows if not r.contaminated)

    out = corpus_pipeline.run(spark, LARGER)
    assert out.columns == [*docs.columns, "copies"]
    copies = {r.doc_id: r.copies for r in out.select("doc_id", "copies").collect()}
    assert set(copies) <= first & second and set(copies.values()) <= {1, 2, 3}
