"""The queries of this package over the given tables: name -> function of (spark, folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens.llm import (
    conversations,
    decontaminate,
    exact_dedup,
    html_extract,
    jaccard_join,
    language_id,
    language_model,
    mixing,
    pii,
    quality,
    runs,
    secrets,
    warc,
)
from tourlens.llm.common import fold, table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"), html_extract.trained())


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = language_id.identify(docs.select("doc_id", "text"), language_id.train(docs))
    held_out = fold(F.col("doc_id"), language_id.FOLDS) == language_id.HELD_OUT
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at"
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"), pii.train(spark))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).alias("taken")
    rows = mixing.allocation(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(runs.looped(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", runs.strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.audits(conversations.repairs(conversations.damaged(rows)))
    ids = rows.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(repaired, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = language_model.score(docs, fold(F.col("doc_id"), 5) != 1)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", *[F.round(c, 6).alias(c) for c in ("base_score", "score")])


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lm_scores": op13_lm_scores,
}


_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
_BLANK = r"\x20\x09-\x0D"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"



def _crc32(key: str) -> str:
    """DuckDB SQL of the checksum of an ASCII text: the register meets each byte, then eight single steps (-1)."""
    steps = f"flatten(list_transform(string_split({key}, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, b: {step}), 4294967295)"


#: DuckDB SQL of the queries that it can express; the others are tested against brute force.
ORACLES = {
    "op3_exact_dedup": f"""
        WITH hashed AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256 FROM documents
        ), grouped AS (
            SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
                count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM hashed
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM grouped
    """,
    "op12_conversation_repair": f"""
        WITH RECURSIVE marked AS (
            SELECT *, {_crc32("conv_id || ':' || turn")} % 20 AS h FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM marked WHERE h <> 0
        ), faults AS (
            SELECT *, role[1] AS initial, regexp_extract(text, '([^{_BLANK}])[{_BLANK}]*$', 1) AS last,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text, copy) AS i,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn, copy) AS met
            FROM damaged
        ), given AS (
            SELECT *, CASE WHEN last = '' THEN 'b' WHEN met > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
                lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM faults
        ), sizes AS (
            SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
                count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM given GROUP BY conv_id
        ), inserts(s, cost, edits, t, lines) AS (
            -- Inserted rows before an edit or the end; states: 0 begin, 1 system, 2 user, 3 assistant
            SELECT s, 0, '', s, [] FROM (VALUES (0), (1), (2), (3)) AS v(s)
            UNION ALL SELECT s, 2, 'I', CASE WHEN s = 2 THEN 3 ELSE 2 END, [CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END] FROM (VALUES (0), (1), (2), (3)) AS v(s)
            UNION ALL SELECT s, 4, 'II', CASE WHEN s = 2 THEN 2 ELSE 3 END,
                CASE WHEN s = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END FROM (VALUES (0), (1), (2), (3)) AS v(s)
        ), paths AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS s, 0 AS cost, '' AS edits, []::VARCHAR[] AS lines FROM sizes
            UNION ALL
            SELECT p.conv_id, g.i, e.s, p.cost + n.cost + e.cost + CASE WHEN fault = 't' AND e.edit <> 'D' THEN 1 ELSE 0 END AS cost, p.edits || n.edits || e.edit AS edits,
                list_concat(p.lines, list_concat(n.lines, CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [g.role || ':' || g.text]
                    ELSE [CASE WHEN e.s = 2 THEN 'user' ELSE 'assistant' END || ':' || g.text] END)) AS lines
            FROM paths p JOIN inserts n ON n.s = p.s JOIN given g ON g.conv_id = p.conv_id AND g.i = p.i + 1
            JOIN (
                SELECT t, 'D' AS edit, 3 AS cost, t AS s, NULL AS initial FROM (VALUES (0), (1), (2), (3)) AS v(t)
                UNION ALL SELECT t, 'R', 2, CASE WHEN t = 2 THEN 3 ELSE 2 END, NULL FROM (VALUES (0), (1), (2), (3)) AS v(t)
                UNION ALL SELECT t, 'K', 0, CASE WHEN t = 2 THEN 3 ELSE 2 END, CASE WHEN t = 2 THEN 'a' ELSE 'u' END FROM (VALUES (0), (1), (2), (3)) AS v(t)
                UNION ALL SELECT 0, 'K', 0, 1, 's'
            ) e ON e.t = n.t AND (e.edit = 'D' OR fault NOT IN ('b', 'd')) AND (e.initial IS NULL OR e.initial = g.initial)
            QUALIFY row_number() OVER (PARTITION BY p.conv_id, e.s ORDER BY p.cost + n.cost + e.cost + CASE WHEN fault = 't' AND e.edit <> 'D' THEN 1 ELSE 0 END, p.edits || n.edits || e.edit) = 1
        ), ended AS (
            SELECT p.conv_id, p.cost + n.cost AS cost, p.edits || n.edits AS audit, list_concat(p.lines, n.lines) AS lines
            FROM paths p JOIN sizes z ON z.conv_id = p.conv_id AND z.n = p.i JOIN inserts n ON n.s = p.s AND n.t IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + n.cost, p.edits || n.edits) = 1
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN sizes USING (conv_id) LEFT JOIN ended USING (conv_id)
    """,
    "op13_lm_scores": f"""
        WITH words AS (
            SELECT doc_id, {_crc32("doc_id::VARCHAR")} % 5 = 1 AS held_out,
                list_append(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}'), ' ') AS words
            FROM documents
        ), tokens AS (
            SELECT doc_id, held_out, unnest(words) AS w, unnest(list_prepend('  ', words)[:len(words)]) AS u FROM words
        ), singles AS (
            SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w
        ), contexts AS (
            SELECT u, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY u
        ), pairs AS (
            SELECT u, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY u, w
        ), sums AS (
            SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM singles
        ), scored AS (
            SELECT doc_id, held_out, s.c, (coalesce(s.c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1)) AS p, coalesce(b.c, 0) AS paired, coalesce(x.c, 0) AS opened, n
            FROM tokens t CROSS JOIN sums LEFT JOIN singles s ON s.w = t.w LEFT JOIN contexts x ON x.u = t.u LEFT JOIN pairs b ON b.u = t.u AND b.w = t.w
        )
        SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, round(sum(log10(p)), 6) AS base_score,
            round(sum(log10((paired + {language_model.STRENGTH}::DOUBLE * p) / (opened + {language_model.STRENGTH}::DOUBLE))), 6) AS score
        FROM scored GROUP BY doc_id, held_out
    """,
}
