"""Secret scans: fixed patterns, and character Markov models of random strings against identifiers.

Patterns find assignments, access keys and long hexadecimal strings. Besides, every long token is scored by two
first-order Markov chains over characters, one of random strings and one of ordinary identifiers and words: the mean
log-likelihood ratio of its transitions. Tokens above a threshold, set so that at most one in a thousand ordinary
samples passes, are spans of kind `random` where no pattern span overlaps them. Short means vary more, so tokens of
`SHORTEST` to `FULL - 1` characters have a threshold for each length, set on ordinary samples of that length; of these,
tokens without a letter are numbers (dates, telephones, cards) and not scored.

The chains are counted by Spark on labelled samples: random strings are digests of numbers in three spellings; ordinary
ones are identifiers put together from common words, and words of letters from at most `SAMPLE` documents
(the documented bound, by the order of a digest of their ids). Everything is column expressions.

Defined cases: a null text counts as empty: no spans. Overlapping spans of different patterns all stay. Ties in start are in order of kinds.
Rows are scanned one by one, so repeated rows and null ids pass through. An empty table gives an empty result (chains then know no words of documents).
Only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens.llm import spans
from tourlens.llm.common import drawn, part
from tourlens.sources import workspace

#: Fixed patterns. Those that can match nothing shorter are anchored at the first character of a run.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGNED = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
LONG = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}+"
#: Fewest characters of a scored token, and of one that has the common threshold.
SHORTEST, FULL = 12, 20
KINDS = ("assign", "access", "hex", "random")

#: Documents whose words the ordinary chain learns at most.
SAMPLE = 500
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
#: Part of ordinary samples that may pass.
PASS = 0.001

# Words of identifiers.
WORDS = (
    "access account action active address array author base batch block buffer build cache call check class client close code column "
    "config connection content context count create current cursor data date default delete detail device document element enable "
    "entry error event export field file filter first folder format frame function group handler header height identifier image "
    "index input instance item key label last layout length level limit line list load local manager message method model module "
    "name network node number object offset option order output owner package page parent password path pattern position price "
    "process product profile query random record remote report request resource response result secret section select server "
    "service session size source start state status string style system table target task template text thread time title token "
    "transaction type update user value version view width window worker"
).split()


@dataclass(frozen=True)
class Chains:
    """Log-likelihood ratios of transitions, row by row of the alphabet (others last), and the thresholds."""

    ratios: tuple[float, ...]
    threshold: float
    short: tuple[float, ...] = ()  # thresholds of SHORTEST to FULL - 1 characters

    def is_random(self, token: Column) -> Column:
        size = F.length(token)
        least = F.element_at(F.array(*map(F.lit, self.short)), size - (SHORTEST - 1))
        short = F.when(token.rlike("[A-Za-z]"), self.mean_ratio(token) > least).otherwise(False)
        return F.when(size >= FULL, self.mean_ratio(token) > self.threshold).otherwise(short)

    def mean_ratio(self, token: Column) -> Column:
        """Mean log-likelihood ratio of the token's transitions, random over ordinary."""
        n = len(ALPHABET) + 1
        table = F.split(F.lit(",".join(f"{x:.5f}" for x in self.ratios)), ",").cast("array<double>")

        def place(i: Column) -> Column:
            return F.call_function("locate", F.substring(token, i, F.lit(1)), F.lit(ALPHABET)) - 1

        def add(total: Column, i: Column) -> Column:
            a, b = place(i), place(i + 1)
            spot = F.when(a < 0, n - 1).otherwise(a) * n + F.when(b < 0, n - 1).otherwise(b)
            return total + F.element_at(table, spot + 1)

        steps = F.length(token) - 1
        return F.when(steps > 0, F.aggregate(F.sequence(F.lit(1), steps), F.lit(0.0), add) / steps).otherwise(0.0)


def labelled(spark: SparkSession, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Samples: token and whether it is random."""
    n = F.col("id").cast("string")
    digest = F.sha2(n, 256)
    packed = F.translate(F.base64(F.unhex(digest)), "=", "")
    random = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.substring(digest, 1, 40))
        .when(F.col("id") % 3 == 1, packed)
        .otherwise(F.substring(F.upper(F.translate(packed, "+/", "")), 1, 32))
        .alias("token"),
        F.lit(True).alias("random"),
    )
    words = F.array(*map(F.lit, WORDS))

    def word(step: int) -> Column:
        return F.element_at(words, (F.col("id") * step % len(WORDS) + 1).cast("int"))

    parts = F.array(word(1), word(7), word(31), word(57))
    kind = F.col("id") % 5
    identifiers = spark.range(3000).select(
        F.when(kind == 0, F.array_join(parts, "_"))
        .when(kind == 1, F.array_join(F.transform(parts, F.initcap), ""))
        .when(kind == 2, F.array_join(parts, "-"))
        .when(kind == 3, F.upper(F.array_join(parts, "_")))
        .otherwise(F.concat(F.array_join(parts, "/"), F.lit("/v"), (F.col("id") % 10).cast("string")))
        .alias("token"),
        F.lit(False).alias("random"),
    )
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null")
    # Few whole texts come to one task, however many tasks read the table.
    sample = sample.where(drawn(F.col("id")) <= part(SAMPLE, sample.count()))
    sample = sample.orderBy(F.xxhash64("id"), "id", F.md5(F.col("text").cast("binary"))).limit(SAMPLE)
    spoken = sample.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{8,}"), F.lit(0))).alias("token"), F.lit(False).alias("random"))
    return random.unionByName(identifiers).unionByName(spoken)


def short_ordinary(samples: DataFrame) -> DataFrame:
    """Ordinary tokens of SHORTEST to FULL - 1 characters: beginnings and ends of samples, some with a number or a date and time."""
    token, n = F.col("token"), F.abs(F.xxhash64("token"))
    day = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (n % 16000).cast("int")), "yyyy-MM-dd")
    number = F.substring(n.cast("string"), 1, 6)
    made = samples.where("not random and length(token) >= 20").select(
        F.explode(
            F.array(
                token,
                F.concat(F.substring_index(token, "_", 2), F.lit("_"), number, token),
                F.concat(F.substring_index(token, "-", 1), F.lit("-"), day, F.lit("-"), token),
                F.concat(day, F.lit("T"), F.substring(number, 1, 2), F.lit("-"), token),
            )
        ).alias("token")
    )
    size = F.explode(F.sequence(F.lit(SHORTEST), F.lit(FULL - 1))).alias("size")
    cut = made.select("token", size).select(
        F.explode(F.array(F.expr("left(token, size)"), F.expr("right(token, size)"))).alias("token"), F.lit("made").alias("kind")
    )
    spoken = samples.where(f"not random and length(token) between {SHORTEST} and {FULL - 1}").select("token", F.lit("spoken").alias("kind"))
    return cut.unionByName(spoken)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Chains:
    with workspace.staged(labelled(docs.sparkSession, docs, key, text), "secrets-samples") as samples:
        return fitted(samples)


def fitted(samples: DataFrame) -> Chains:
    """Chains and thresholds from samples: token and whether it is random."""
    steps = samples.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("token") - 1))).where("length(token) > 1")
    pair = F.substring("token", F.col("i"), F.lit(2))
    n = len(ALPHABET) + 1
    counts = {False: [[0.5] * n for _ in range(n)], True: [[0.5] * n for _ in range(n)]}
    place = {c: i for i, c in enumerate(ALPHABET)}
    for kind, both, times in steps.groupBy("random", pair.alias("pair")).count().collect():  # two chains of n * n transitions
        counts[kind][place.get(both[0], n - 1)][place.get(both[1], n - 1)] += times
    logs = {k: [[math.log(x / sum(row)) for x in row] for row in table] for k, table in counts.items()}
    ratios = tuple(logs[True][a][b] - logs[False][a][b] for a in range(n) for b in range(n))
    chains = Chains(ratios, 0.0)
    scored = samples.where("not random and length(token) >= 20").select(chains.mean_ratio(F.col("token")).alias("score"))
    most = scored.agg(F.percentile_approx("score", F.lit(1 - PASS), F.lit(10_000))).first()[0]
    threshold = max(0.2, most or 0.0)
    short = short_ordinary(samples).groupBy(F.length("token").alias("size"), "kind")
    short = short.agg(F.percentile_approx(chains.mean_ratio(F.col("token")), F.lit(1 - PASS), F.lit(10_000)).alias("most"))
    by_size = dict(short.groupBy("size").agg(F.max("most")).collect())  # one row of each length
    return Chains(ratios, threshold, tuple(max(threshold, by_size.get(n, 0.0)) for n in range(SHORTEST, FULL)))


def found(docs: DataFrame, chains: Chains, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, base (array of pattern spans) and added (array of model spans) of every row."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(
        "id",
        "text",
        spans.hits(F.col("text"), ASSIGN).alias("assign"),
        spans.hits(F.col("text"), ACCESS).alias("access"),
        spans.hits(F.col("text"), HEX).alias("hex"),
        spans.hits(F.col("text"), LONG).alias("long"),
    )
    at = {name: spans.located(F.col("text"), F.col(name), pattern, kind, rank) for name, pattern, kind, rank in (
        ("assign", ASSIGN, "assign", 0), ("access", ACCESS, "access", 1), ("hex", HEX, "hex", 2), ("long", LONG, "random", 3)
    )}
    assign = F.filter(at["assign"], lambda s: F.length(F.regexp_extract(s["value"], ASSIGNED, 1)) >= 6)
    access = F.filter(at["access"], lambda s: F.length(s["value"]) >= 20)
    rows = rows.select("id", F.concat(assign, access, at["hex"]).alias("base"), at["long"].alias("long"))
    scored = F.filter(F.col("long"), lambda s: chains.is_random(s["value"]))
    return rows.select("id", "base", spans.apart(scored, F.col("base")).alias("added"))


def scan(docs: DataFrame, chains: Chains, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of the pattern kinds, digest of their spans, and all spans."""
    base = F.col("base")
    return found(docs, chains, key, text).select(
        F.col("id").alias("doc_id"),
        *[spans.count(base, kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(spans.listed(base).cast("binary"), 256).alias("base_sha256"),
        spans.listed(F.concat(base, F.col("added"))).alias("spans"),
    )
