"""Text cleaners, match keys and name filters as column expressions, all of them in the JVM."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode calls white space, then the four
# information separators that landed text treats as white space too.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
    "\x1c\x1d\x1e\x1f"
)
_SPACE = r"[\s\x1c-\x1f]"
_BEYOND_ASCII = r"[^\x00-\x7f]"

# Phrases that mark a listing as something other than a touring artist.
NON_ARTIST_PHRASES = (
    r"\btribut\w*\b",
    r"\bimpersonat\w*\b",
    r"\bcirque\b",
    r"\bon\s+ice\b",
    r"\bday\s+out\s+with\b",
    r"LIVE\s+[–—-]",
    r"\bhologram\b",
    r"\bthe\s+\w+\s+experience\b",
    r"\bopry\b",
    r"\bcelebrat\w*\b",
    r"\bmusical\b",
    r"\bbroadway\b",
    r"\bspectacular\b",
    r"\bresidency\b",
    r"\blegacy\b",
    r"\b(?:sounds?|songs?|music|echoes?|rumours?)\s+of\b",
    r"\b(?:salute|homage)\s+to\b",
)

# Words in an artist's disambiguation that mark a tribute or cover act.
TRIBUTE_WORDS = ("tribute", "cover band", "impersonat", "tribute band", "cover")

# The punctuation after which a title-cased word starts, besides white space.
WORD_BREAKS = r"\[\](){}/|<>!?@\"^#$&~_,.:;*%+\-"


def strip(c: Column) -> Column:
    """Remove white space at both ends (Spark's plain `trim` only knows U+0020)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def name_key(c: Column) -> Column:
    """Case- and blank-insensitive join key; null stays null and so matches nothing."""
    return F.lower(strip(c))


def cache_key(c: Column) -> Column:
    """As `name_key`, with null as the empty string."""
    return name_key(F.coalesce(c, F.lit("")))


def strip_qualifier(c: Column) -> Column:
    """Drop one trailing parenthesised qualifier: 'Name (US Tour)' -> 'Name'."""
    return strip(F.regexp_replace(c, rf"(?U){_SPACE}*\([^)]*\){_SPACE}*$", ""))


#: Hangul syllables are letters of three tables by arithmetic.
SYLLABLES = ("\uac00", "\ud7a3")


@functools.cache
def _decompositions() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that fold to one other or none, and those that fold to several (Hangul syllables apart)."""
    short, long = {}, {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        if not (unicodedata.decomposition(char) or unicodedata.combining(char)):
            continue
        parts = unicodedata.normalize("NFKD", char)
        folded = "".join(p for p in parts if not unicodedata.combining(p))
        if folded != char and not SYLLABLES[0] <= char <= SYLLABLES[1]:
            (short if len(folded) < 2 else long)[char] = folded
    return short, long


def _ranges(chars: str) -> str:
    """Characters above ASCII as the inside of a pattern's class; a class of single ones would be tried one after the other."""
    codes, parts = sorted(map(ord, chars)), []
    for code in codes:
        if parts and parts[-1][1] == code - 1:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in parts)


def _jamo(char: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    place = F.ascii(char) - ord(SYLLABLES[0])
    lead, vowel, tail = ("".join(map(chr, range(a, a + n))) for a, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))
    parts = (lead, F.floor(place / 588)), (vowel, F.floor(F.pmod(place, F.lit(588)) / 28)), (tail, F.pmod(place, F.lit(28)) - 1)
    return F.concat(*[F.when(at < 0, "").otherwise(F.substr(F.lit(table), at.cast("int") + 1, F.lit(1))) for table, at in parts])


def fold_accents(c: Column) -> Column:
    """NFKD-decompose and drop combining marks.

    ASCII text is its own decomposition. Of other text most characters fold to one or none, which is one
    `translate`; only in text with a ligature, fraction, syllable and the like these are taken out, and the rest is kept in long pieces.
    """
    short, long = _decompositions()
    # Characters without a counterpart, at the end, are dropped.
    ordered = sorted(short, key=lambda ch: (not short[ch], ch))
    single = F.translate(c, "".join(ordered), "".join(short[ch] for ch in ordered))
    several = "".join(long)

    def apart(char: Column) -> Column:
        other = F.get(F.array(*map(F.lit, long.values())), F.instr(F.lit(several), char) - 1)
        return F.when(char.between(*SYLLABLES), _jamo(char)).otherwise(F.coalesce(F.when(F.length(char) > 0, other), char))

    taken = _ranges(several) + "-".join(SYLLABLES)
    pieces = F.regexp_extract_all(single, F.lit(rf"[\x00-\x7f]+|[^\x00-\x7f{taken}]+|[{taken}]"), F.lit(0))
    whole = F.array_join(F.transform(pieces, lambda piece: F.when(F.length(piece) > 1, piece).otherwise(apart(piece))), "")
    # The class is tried on characters above ASCII only.
    is_long = single.rlike(rf"(?=[^\x00-\x7f])[{taken}]")
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.when(is_long, whole).otherwise(single)).otherwise(c)


def simplify_folded(c: Column, classes: str = "(?U)") -> Column:
    """The JVM-side part of `normalise_name`, for text whose accents are folded already.

    `classes` is the flag for character classes: of Unicode, or none for ASCII text, where both agree.
    """
    no_article = F.regexp_replace(F.lower(c), rf"{classes}^the{_SPACE}+", "")
    spelled_and = F.replace(no_article, F.lit("&"), F.lit(" and "))
    plain = F.regexp_replace(spelled_and, rf"{classes}[^a-z0-9\s\x1c-\x1f]", "")
    return F.trim(F.regexp_replace(plain, rf"{classes}{_SPACE}+", " "))


def normalise_name(c: Column) -> Column:
    """Aggressive form for entity matching: no accents, article, punctuation or runs of blanks."""
    name = strip(F.coalesce(c, F.lit("")))
    # Classes of Unicode are slow, and ASCII names have nothing to fold.
    return F.when(name.rlike(_BEYOND_ASCII), simplify_folded(fold_accents(name))).otherwise(simplify_folded(name, ""))


def normalise_names(names: Column) -> Column:
    """`normalise_name` for an array of names."""
    return F.transform(names, normalise_name)


def is_non_artist(c: Column) -> Column:
    """Does the name read like a show, tribute or residency rather than a touring artist?"""
    name = F.coalesce(c, F.lit(""))
    # Most phrases start at a word: that is tried once for all of them. Classes of Unicode are for names beyond ASCII only.
    at_word = "|".join(p.removeprefix(r"\b") for p in NON_ARTIST_PHRASES if p.startswith(r"\b"))
    phrases = "|".join([rf"\b(?:{at_word})", *(p for p in NON_ARTIST_PHRASES if not p.startswith(r"\b"))])
    return F.when(name.rlike(_BEYOND_ASCII), name.rlike("(?iU)" + phrases)).otherwise(name.rlike("(?i)" + phrases))


def mentions_tribute(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).rlike("|".join(TRIBUTE_WORDS))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of each word, where punctuation also starts a word."""
    pieces = F.regexp_extract_all(
        F.lower(c), F.lit(rf"(?U)([^\s{WORD_BREAKS}]+|[\s{WORD_BREAKS}])"), F.lit(1)
    )
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))),
        "",
    )


def join_songs(songs: Column) -> Column:
    """'; '-separated song list, null when there is none."""
    return F.when(F.size(songs) > 0, F.array_join(songs, "; "))


def split_songs(c: Column) -> Column:
    return F.split(c, "; ")
