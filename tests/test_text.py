import unicodedata

from pyspark.sql import functions as F

from tourlens.functions import text


def test_strip_and_keys(evaluate):
    assert evaluate(text.name_key, ["  Coldplay ", "COLDPLAY", "Coldplay ", "　Coldplay\n", None]) == [
        "coldplay"
    ] * 4 + [None]
    assert evaluate(text.cache_key, [None, " A "]) == ["", "a"]


def test_strip_qualifier(evaluate):
    given = ["Donny Osmond (Las Vegas)", "Keith Urban (US Tour)", "Sunn O)))", "(Sandy) Alex G", "A (b) (c)"]
    assert evaluate(text.strip_qualifier, given) == [
        "Donny Osmond",
        "Keith Urban",
        "Sunn O)))",
        "(Sandy) Alex G",
        "A (b)",
    ]


NAMES = {
    "León": "leon",
    "The Who": "who",
    "Jools Holland & His Orchestra": "jools holland and his orchestra",
    "AC/DC": "acdc",
    "The The": "the",
    "ﬁnch": "finch",
    "坂本龍一": "",
    "  a   b ": "a b",
    "ÅNGSTRÖM": "angstrom",
    None: "",
}


def test_normalise_name(evaluate):
    assert evaluate(text.normalise_name, list(NAMES)) == list(NAMES.values())


def test_normalise_names_equals_one_by_one(evaluate):
    given = [list(NAMES), [], ["x\x1fy"]]
    out = evaluate(text.normalise_names, given, "ARRAY<STRING>")
    assert out[0] == list(NAMES.values())
    assert out[2] == ["x y"]


def test_title_case(evaluate):
    given = ["hip-hop", "r&b", "POP rock", "", None, "drum'n'bass", "élan vital"]
    assert evaluate(text.title_case, given) == [
        "Hip-Hop",
        "R&B",
        "Pop Rock",
        "",
        None,
        "Drum'n'bass",
        "Élan Vital",
    ]


def test_non_artists(evaluate):
    shows = [
        "ABBA Tribute",
        "Disney On Ice",
        "MJ LIVE – The Show",
        "The Hendrix Experience",
        "Rumours of Fleetwood Mac",
        "A Salute to the Stars",
        "Tributary",
        "Grand Ole Opry",
        "Day  Out With Thomas",
        "Michael Jackson - Legacy",
        "The Björk Experience",
    ]
    artists = ["Iceage", "Muse", "", None, "Legacies", "Song"]
    assert evaluate(text.is_non_artist, shows + artists) == [True] * len(shows) + [False] * len(artists)


def test_tribute_words(evaluate):
    given = ["Queen TRIBUTE band", "covers project", None, "rock band", "impersonator"]
    assert evaluate(text.mentions_tribute, given) == [True, True, False, False, True]


def test_songs(evaluate):
    assert evaluate(text.join_songs, [["A", "B"], [], None, [""]], "ARRAY<STRING>") == ["A; B", None, None, ""]
    assert evaluate(text.split_songs, ["A; B; "]) == [["A", "B", ""]]


def test_folding_is_that_of_unicode_and_stays_in_the_jvm(spark):
    codes = [*range(1, 0x3400), *range(0xAC00, 0xD7A4, 7), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200), *range(0x2F800, 0x2FA1E)]
    rows = [(f"a{chr(i)}z",) for i in codes] + [("e\u0301\u0323 ﬁ ½ 한글 ©",), (None,), ("",)]
    out = spark.createDataFrame(rows, "v STRING").select("v", text.fold_accents(F.col("v")).alias("folded"))

    def folded(v):
        return v and "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))

    assert [r for r in out.collect() if r.folded != folded(r.v)] == []
    names = spark.range(1).select(text.normalise_names(F.array(F.lit("É"))), text.normalise_name(F.lit("ö")))
    assert "Python" not in names._jdf.queryExecution().executedPlan().toString()


def test_texts_with_a_ligature_are_not_taken_apart_by_character(evaluate):
    long = "plain text " * 200
    odd = [f"{long}\ufb01 \u00bd {long}", "\ufb01", "\ud55c\uae00 \u4e2d\u6587 \u01c6 \U0001f600\U0001d400", "\u00bc\u00bd" * 3]
    want = ["".join(ch for ch in unicodedata.normalize("NFKD", v) if not unicodedata.combining(ch)) for v in odd]
    assert evaluate(text.fold_accents, odd) == want
    from pyspark.sql import functions as F

    assert "(?s)." not in str(text.fold_accents(F.col("v")))
    assert text._ranges("\u0105\u0100\u0101") == "\u0100-\u0101\u0105-\u0105"


def test_classes_of_unicode_are_for_names_beyond_ascii(evaluate):
    names = ["The  A&B\x1c Band!", "THE_X the y", "aLIVE - x", "xLIVE \u2014 y", "Cirqu\u00e9", "\u017falute to x", "Song\u00a0of x", "songs of x",
             "on ice", "on icey", "\u00e9on ice", "echoes\nof x", "The Caf\u00e9 Experience", "The A_1 experience", "tributes", "atribute", "the\x1fthe x", "", None]
    whole = lambda c: F.coalesce(c, F.lit("")).rlike("(?iU)" + "|".join(text.NON_ARTIST_PHRASES))
    assert evaluate(text.is_non_artist, names) == evaluate(whole, names)
    folded = lambda c: text.simplify_folded(text.fold_accents(text.strip(F.coalesce(c, F.lit("")))))
    assert evaluate(text.normalise_name, names) == evaluate(folded, names)
