"""Personal data: fixed patterns, and candidates judged by boosted trees.

Patterns find e-mail addresses, IP addresses, card numbers (Luhn) and international phone numbers. Besides, wide generators
propose overlapping candidates: spelt-out addresses, runs of digits in groups, IPv6-like groups. Each becomes
a vector of yes-no features of its format and the words before it; gradient-boosted trees of depth two give a margin,
a logistic fitted to margins of held-out folds turns it into a probability, and candidates above the
threshold that overlap no pattern span are added, with their generator as kind.

The trees are fitted to labelled samples (below): Spark turns them into features by the same expressions, and
the few distinct vectors with their label counts are all that boosting needs. Scanning is column expressions only.

Defined cases: a null text counts as empty: no spans. Failing matches of a pattern are dropped without a second try inside
them. Ties in start are in order of kinds. Rows are scanned one by one, so repeated rows and null ids pass through; an empty table gives an
empty result. Only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens.llm import spans

#: Fixed patterns; repeats that cannot give back are possessive and starts are anchored, so that long runs cost their length.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: Wide generators of candidates.
GENERATORS = {
    "contact": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[(\[](?:at|AT)[)\]])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]{1,63}+){0,6}+",
    "number": r"(?<![0-9A-Za-z.+])[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9]){6,22}+(?![0-9A-Za-z])",
    "address": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
}
#: Code points before a candidate that its context features see.
CONTEXT = 30
THRESHOLD = 0.9
ROUNDS, RATE, FOLDS = 40, 0.3, 4

# Labelled samples: words before, candidate. Fixed values, invented.
PRIVATE = [
    ("write to ", "jane.doe (at) example (dot) org"), ("mail me: ", "sam[at]example[dot]com"), ("contact ", "kim.lee (at) example.net"),
    ("reach him at ", "joe [at] example [dot] co"), ("address ", "ann (AT) example (DOT) com"), ("e-mail ", "max[AT]example[DOT]net"),
    ("call me on ", "(415) 555-0132"), ("phone: ", "212-555-0187"), ("tel. ", "020 7946 0958"), ("fax ", "(030) 555 0100"),
    ("mobile ", "555-867-5309"), ("my cell is ", "646 555 0143"), ("telephone ", "(02) 5550 1234"), ("whatsapp ", "07700 900123"),
    ("call ", "800-555-0199"), ("phone number ", "5105550134"), ("tel ", "01632960001"), ("mobile: ", "0151 23456789"),
    ("ssn ", "078-05-1120"), ("social security number ", "219-09-9999"), ("SSN: ", "457-55-5462"), ("social security ", "123-45-6789"),
    ("taxpayer ", "321-54-9876"), ("her number is ", "412-68-3321"), ("host ", "2001:db8:0:42:1:8a2e:370:7334"), ("from ", "fe80:0:0:0:204:61ff:fe9d:f156"),
    ("client address ", "2001:db8:85a3:8d3:1319:8a2e:370:7348"), ("login from ", "2001:db8:1:2:3:4:5:6"),
    ("card ", "4111.1111.1111.1111"), ("visa ", "(4012) 8888 8888 1881"), ("credit card ", "5555.5555.5555.4444"), ("amex ", "3782.822463.10005"),
]
ORDINARY = [
    ("order ", "1353681299978555"), ("item ", "2428694969355626"), ("the result ", "4541241989961675"), ("invoice ", "6126142746547109"),
    ("and ", "3714655751500287"), ("of ", "6874314485609552"), ("in ", "1683436113538829"), ("total of ", "5374040645122201"),
    ("serial ", "00012345678"), ("isbn ", "978-3-16-148410-1"), ("id ", "20231204101500"), ("version ", "10.15.7.1.22.33"),
    ("from ", "1914-1918"), ("years ", "1990 1995 2000"), ("pages ", "100-105 and"), ("part no. ", "123-4567-890"),
    ("population ", "7.800.000.000"), ("date ", "2023-12-04"), ("on ", "04.12.2023"), ("since ", "12-11-2019"),
    ("count ", "12345678"), ("about ", "1000000000"), ("sum ", "99 100 101"), ("ref ", "55512345678901"),
    ("number ", "31415926535897"), ("score ", "10-7 8-6 7-5"), ("build ", "20240115.12345"), ("order no. ", "4452239912"),
    ("time ", "12:30:45:10:11"), ("ratio ", "1:2:3:4:5"), ("at ", "10:20:30:40:50:60"), ("mentions ", "team@work"),
    ("says ", "hello@all"), ("user ", "x@y"), ("the ", "1200 1300 1400 1500"), ("price ", "4111111111111112"),
    ("and ", "8005550199777"), ("with ", "40128888888818"), ("code ", "1122334455"), ("phone model ", "3310 3310 33"),
]

_PHONE_WORDS = r"(phone|call|tel|mobile|cell|fax|whatsapp|reach|sms)[a-z]*[\W\w]{0,12}$"
_CARD_WORDS = r"(card|visa|master|amex|credit|debit)[a-z]*[\W\w]{0,12}$"
_ID_WORDS = r"(order|invoice|item|serial|isbn|version|id|ref|no|number|code|part|build|price|total|pages?|date|since|model)\W{0,3}$"
_SSN_WORDS = r"(ssn|social|security|tax)[a-z]*[\W\w]{0,16}$"


def luhn(number: Column) -> Column:
    """Whether the digits of a text pass the Luhn test."""
    backwards = F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), "")
    values = F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


#: Features: name -> condition on the kind, value and context of a candidate.
FEATURES = {
    "contact": lambda k, v, c: k == "contact",
    "address": lambda k, v, c: k == "address",
    "spelt": lambda k, v, c: v.rlike(r"(?i)[(\[](at|dot)[)\]]"),
    "domain": lambda k, v, c: v.rlike(r"(?:\.|(?i:[(\[]dot[)\]]))\x20?[A-Za-z]{2,}$"),
    "7-9": lambda k, v, c: _digits(v).between(7, 9),
    "10-12": lambda k, v, c: _digits(v).between(10, 12),
    "13-19": lambda k, v, c: _digits(v).between(13, 19),
    "luhn": lambda k, v, c: _digits(v).between(13, 19) & luhn(v),
    "brackets": lambda k, v, c: v.rlike(r"^\(?[0-9]*\([0-9]{2,5}\)"),
    "3-2-4": lambda k, v, c: v.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
    "3-3-4": lambda k, v, c: v.rlike(r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$"),
    "plain": lambda k, v, c: v.rlike(r"^[0-9]+$"),
    "hexed": lambda k, v, c: v.rlike(r"[A-Fa-f]") & v.rlike(r"(?:[0-9A-Fa-f]{1,4}:){7}"),
    "eight": lambda k, v, c: v.rlike(r"^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"),
    "date": lambda k, v, c: v.rlike(r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][0-9]{4})$"),
    "after phone": lambda k, v, c: c.rlike(_PHONE_WORDS),
    "after card": lambda k, v, c: c.rlike(_CARD_WORDS),
    "after id": lambda k, v, c: c.rlike(_ID_WORDS),
    "after ssn": lambda k, v, c: c.rlike(_SSN_WORDS),
}


def feature_mask(kind: Column, value: Column, context: Column) -> Column:
    """The features as bits of a number."""
    mask = F.lit(0)
    for i, test in enumerate(FEATURES.values()):
        mask = mask + F.when(test(kind, value, context), 1 << i).otherwise(0)
    return mask


@dataclass(frozen=True)
class Forest:
    """Trees of depth two: first feature, feature if no, feature if yes, four leaves; and the calibration."""

    trees: tuple[tuple[int, int, int, tuple[float, float, float, float]], ...]
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, mask: int) -> float:
        return sum(t[3][2 * (mask >> t[0] & 1) + (mask >> t[2 if mask >> t[0] & 1 else 1] & 1)] for t in self.trees)

    def probability(self, mask: Column) -> Column:
        def has(i: int) -> Column:
            return mask.bitwiseAND(F.lit(1 << i)) != 0

        total = F.lit(0.0)
        for first, no, yes, leaf in self.trees:
            total = total + F.when(has(first), F.when(has(yes), leaf[3]).otherwise(leaf[2])).otherwise(F.when(has(no), leaf[1]).otherwise(leaf[0]))
        return 1 / (1 + F.exp(-(total * self.slope + self.shift)))


def _grown(rows: dict[int, list[int]], rounds: int = ROUNDS) -> Forest:
    """Newton boosting of the log-loss; `rows` maps a vector to its counts of labels 0 and 1."""
    n, trees = len(FEATURES), []
    margin = dict.fromkeys(rows, 0.0)

    def sums(masks: list[int]) -> tuple[float, float]:
        g = h = 0.0
        for m in masks:
            p = 1 / (1 + math.exp(-margin[m]))
            zeros, ones = rows[m]
            g += ones * (1 - p) - zeros * p
            h += (zeros + ones) * p * (1 - p)
        return g, h

    def gain(masks: list[int]) -> float:
        g, h = sums(masks)
        return g * g / (h + 0.3)

    def leaf(masks: list[int]) -> float:
        g, h = sums(masks)
        return RATE * g / (h + 0.3)

    def best(masks: list[int]) -> int:
        return max(range(n), key=lambda i: gain([m for m in masks if m >> i & 1]) + gain([m for m in masks if not m >> i & 1]))

    for _ in range(rounds):
        everything = sorted(rows)
        first = best(everything)
        off, on = [m for m in everything if not m >> first & 1], [m for m in everything if m >> first & 1]
        no, yes = best(off), best(on)
        parts = [[m for m in off if not m >> no & 1], [m for m in off if m >> no & 1], [m for m in on if not m >> yes & 1], [m for m in on if m >> yes & 1]]
        tree = (first, no, yes, tuple(leaf(p) for p in parts))
        for part, value in zip(parts, tree[3], strict=True):
            for m in part:
                margin[m] += value
        trees.append(tree)
    return Forest(tuple(trees))


def _calibrated(margins: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and shift of the logistic of held-out margins, by Newton steps with a small penalty."""
    a, b = 1.0, 0.0
    for _ in range(30):
        ga, gb, haa, hab, hbb = -(a - 1) * 0.1, -b * 0.1, 0.1, 0.0, 0.1
        for x, y in margins:
            p = 1 / (1 + math.exp(-max(min(a * x + b, 30), -30)))
            ga, gb, w = ga + (y - p) * x, gb + (y - p), p * (1 - p)
            haa, hab, hbb = haa + w * x * x, hab + w * x, hbb + w
        det = haa * hbb - hab * hab
        a, b = a + (hbb * ga - hab * gb) / det, b + (haa * gb - hab * ga) / det
    return a, b


def candidates(text: Column, found: dict[str, Column]) -> Column:
    """All proposals with places; `found` has the hits of each generator."""
    return F.concat(*[spans.located(text, found[k], p, k, 4 + i) for i, (k, p) in enumerate(GENERATORS.items())])


def _context(text: Column, span: Column) -> Column:
    begin = F.greatest(span["start"] - CONTEXT, F.lit(0))
    return F.lower(F.substring(text, begin + 1, span["start"] - begin))


def train(spark: SparkSession) -> Forest:
    """Trees from the labelled samples, which go through the generators like any text."""
    rows = [(b + v + " .", y) for y, group in ((0, ORDINARY), (1, PRIVATE)) for b, v in group]
    samples = spark.createDataFrame(rows, "text string, y int")
    found = {k: spans.hits(F.col("text"), p) for k, p in GENERATORS.items()}
    masks = F.transform(candidates(F.col("text"), found), lambda s: feature_mask(s["kind"], s["value"], _context(F.col("text"), s)))
    counts: dict[int, list[int]] = {}
    folds: Counter = Counter()
    collected = samples.select("y", F.explode(masks).alias("mask"), F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(FOLDS)).alias("fold"))
    for y, mask, fold, n in collected.groupBy("y", "mask", "fold").count().collect():  # at most a row per sample
        counts.setdefault(mask, [0, 0])[y] += n
        folds[mask, fold, y] += n
    margins = []
    for held in range(FOLDS):
        kept: dict[int, list[int]] = {}
        for (mask, fold, y), n in folds.items():
            if fold != held:
                kept.setdefault(mask, [0, 0])[y] += n
        forest = _grown(kept)
        margins += [(forest.margin(mask), y) for (mask, fold, y), n in sorted(folds.items()) if fold == held for _ in range(n)]
    return Forest(_grown(counts).trees, *_calibrated(margins))


def found(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, base (array of pattern spans) and added (array of model spans) of every row."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    t = F.col("text")
    guards = {"email": t.contains("@"), "ip": None, "card": None, "phone": t.contains("+")}
    guards |= {"contact": t.contains("@") | t.rlike(r"[(\[](?:at|AT)[)\]]"), "number": None, "address": t.contains(":")}
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True)) | GENERATORS
    searched = {
        k: spans.hits(t, p) if guards[k] is None else F.when(guards[k], spans.hits(t, p)).otherwise(none) for k, p in patterns.items()
    }
    rows = rows.select("id", "text", *[c.alias(k) for k, c in searched.items()])
    at = {k: spans.located(t, F.col(k), patterns[k], k, i) for i, k in enumerate(KINDS)}
    ip = F.filter(at["ip"], lambda s: F.forall(F.split(s["value"], r"\."), lambda x: F.length(F.regexp_replace(x, "^0+", "")).between(0, 3) & (F.substring(x, -9, 9).cast("int") <= 255)))
    card = F.filter(at["card"], lambda s: _digits(s["value"]).between(14, 19) & luhn(s["value"]))
    phone = F.filter(at["phone"], lambda s: _digits(s["value"]).between(10, 15))
    proposals = candidates(t, {k: F.col(k) for k in GENERATORS})
    judged = F.transform(
        proposals, lambda s: F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), feature_mask(s["kind"], s["value"], _context(t, s)).alias("mask"))
    )
    rows = rows.select("id", F.concat(at["email"], ip, card, phone).alias("base"), judged.alias("proposals"))
    likely = F.filter(F.col("proposals"), lambda s: forest.probability(s["mask"]) >= THRESHOLD)
    return rows.select("id", "base", spans.apart(likely, F.col("base")).alias("added"))


def scan(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of the pattern kinds, digest of their spans, and all spans."""
    base = F.col("base")
    return found(docs, forest, key, text).select(
        F.col("id").alias("doc_id"),
        *[spans.count(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans.listed(base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", spans.listed(F.concat(*[F.transform(F.col(c), lambda s: F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"))) for c in ("base", "added")]))).alias("spans"),
    )
