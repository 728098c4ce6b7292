"""Text expressions: Column -> Column."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def norm_title(c: Column) -> Column:
    """Lower case; everything but Latin letters, digits and Hangul becomes one space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9가-힣]+", " "))


def tokens(c: Column) -> Column:
    """Distinct words of two or more letters or digits, and neighbouring pairs joined by ``_``."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([가-힣a-z0-9]{2,})"), F.lit(1))
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit("_"), b))
    return F.array_distinct(F.concat(words, pairs))


def title_tokens(c: Column) -> Column:
    """Distinct words of two or more letters or digits as they are written, and neighbouring pairs joined by ``_``."""
    words = F.regexp_extract_all(c, F.lit("([가-힣a-zA-Z0-9]{2,})"), F.lit(1))
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.concat(words, F.zip_with(F.slice(words, 1, rest), F.slice(words, 2, rest), lambda a, b: F.concat(a, F.lit("_"), b))))


def informative_tokens(c: Column, stopwords: list[str]) -> Column:
    """Distinct words, lower case, without stop words and numbers."""
    words = F.regexp_extract_all(F.lower(c), F.lit("[0-9]++(?![가-힣a-z])|([가-힣a-z0-9]{2,})"), F.lit(1))  # numbers are empty words
    return F.array_except(words, F.array(*[F.lit(w) for w in ("", *stopwords)]))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def overlap(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def term_hits(text: Column, terms: list[str]) -> Column:
    """Those of ``terms`` that are whole words of a normalised text, in the order of ``terms``."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.instr(padded, F.concat(F.lit(" "), t, F.lit(" "))) > 0)


def unescape(c: Column) -> Column:
    """All character references of HTML, named and numeric, decoded once. Only texts with an ampersand go to Python."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: html.unescape(x) if x else x)

    return F.when(c.contains("&"), run(F.when(c.contains("&"), c))).otherwise(c)


def clean_html(c: Column) -> Column:
    """References decoded, then tags out, white space of any kind to single spaces."""
    return untagged(unescape(c))


def untagged(c: Column) -> Column:
    """Tags out, white space of any kind to single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"(?U)\s+", " "))


def object_particle(word: Column) -> Column:
    """A Korean word with the object particle that its last syllable asks for: 을 after a final consonant, else 를."""
    code = F.ascii(F.substring(word, -1, 1))
    hangul = (code >= 44032) & (code <= 55203)
    return F.concat(word, F.when(hangul & ((code - 44032) % 28 > 0), F.lit("을")).otherwise(F.lit("를")))


def event_tokens(c: Column, aliases: dict[str, str], stopwords: list[str]) -> Column:
    """Distinct words of a normalised text in their base form, of three or more letters, without stop words and numbers."""
    words = F.split(norm_title(c), " ")
    base = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.array_distinct(F.filter(F.transform(words, lambda w: F.coalesce(base[w], w)), lambda w: (F.length(w) >= 3) & ~w.isin(stopwords) & ~w.rlike("^[0-9]+$")))


def one_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def sentences(c: Column) -> Column:
    """The parts of a text after each end of a sentence."""
    return F.split(one_line(c), r"(?<=[.!?]) ")


def squeezed(c: Column) -> Column:
    """One space for white space; blanks, dashes, dots in the middle, bars and commas at the ends go."""
    return F.btrim(one_line(F.coalesce(c, F.lit(""))), F.lit(" -·|,"))


def without_labels(c: Column) -> Column:
    """A headline without the labels in brackets before it."""
    return squeezed(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s*(?:\[[^\]]{1,30}\]\s*)+", ""))


def line_without_labels(c: Column) -> Column:
    """:func:`without_labels` of a text that is one line already (:func:`one_line`); most have no label, so that only their ends are looked at."""
    return F.when(c.contains("["), without_labels(c)).otherwise(F.btrim(c, F.lit(" -·|,")))


def has_any(c: Column, parts: list[str]) -> Column:
    """Whether a text contains one of ``parts``, whatever the case."""
    def found(low: Column) -> Column:
        out = F.lit(False)
        for part in parts:
            out = out | low.contains(part.lower())
        return out

    return let(F.lower(c), found)


#: Hangul syllables without a final consonant, by rule, for a class of characters.
_OPEN = "".join(chr(0xAC00 + 28 * k) for k in range((0xD7A3 - 0xAC00) // 28 + 1))


def has_final_consonant(c: Column) -> Column:
    """Whether the last letter or digit of a text is a Hangul syllable with a final consonant."""
    last = F.regexp_extract(c, r"([\p{L}\p{N}])[^\p{L}\p{N}]*$", 1)
    return last.rlike(f"^[가-힣&&[^{_OPEN}]]$")


def particle(c: Column) -> Column:
    """The object particle that a text asks for: 을 after a final consonant, else 를."""
    return F.when(has_final_consonant(c), F.lit("을")).otherwise(F.lit("를"))


def polish_summary_line(c: Column) -> Column:
    """The object particle after each quoted headline before 비롯한, by the headline's last letter or digit."""
    closed = rf"('[^']*[가-힣&&[^{_OPEN}]][^\p{{L}}\p{{N}}']*')[을를](?= 비롯한)"
    other = rf"('(?:[^']*(?:[\p{{L}}\p{{N}}&&[^가-힣]]|[{_OPEN}]))?[^\p{{L}}\p{{N}}']*')[을를](?= 비롯한)"
    return F.regexp_replace(F.regexp_replace(c, other, "$1를"), closed, "$1을")
