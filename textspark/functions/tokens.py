"""Tokenisers, sentences and n-grams, all inside the row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textspark.functions import patterns
from textspark.functions.arrays import bind
from textspark.functions.clean import strip

Tokenizer = Callable[[Column], Column]

_BREAK = "\u0001"
_GUARD = "\u0002"
# Common abbreviations whose full stop does not end a sentence.
ABBREVIATIONS = ("bl.a.", "ca.", "dr.", "dvs.", "e.g.", "etc.", "evt.", "f.eks.", "i.e.", "jf.", "mr.", "mrs.",
                 "nr.", "o.l.", "osv.", "pga.", "prof.", "z.b.")


def find_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def word_tokens(text: Column, lowercase: bool = True) -> Column:
    """Runs of two or more word characters, lowercased: the default of a bag of words."""
    return find_all(F.lower(text) if lowercase else text, patterns.WORD_2PLUS)


def symbol_tokens(text: Column, lowercase: bool = True) -> Column:
    """Words, and runs of symbols such as smileys."""
    return find_all(F.lower(text) if lowercase else text, patterns.WORD_OR_SYMBOLS)


def raw_tokens(text: Column) -> Column:
    return find_all(F.lower(text), patterns.WORD)


def alnum_tokens(text: Column, lowercase: bool = False) -> Column:
    """Runs of letters and digits; an underscore separates."""
    return find_all(F.lower(text) if lowercase else text, patterns.ALNUM)


def space_tokens(text: Column) -> Column:
    return F.split(text, " ")


def sentences(text: Column, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """Split after . ! or ? when white space follows, except behind an abbreviation."""
    guarded = text
    if abbreviations:
        known = "|".join(patterns.quote(a) for a in sorted(abbreviations, key=lambda a: (-len(a), a)))
        guarded = F.regexp_replace(
            text, rf"(?iu)(^|[^{patterns.WORD_CHARS}])({known})", f"$1$2{_GUARD}"
        )
    broken = F.regexp_replace(guarded, rf"([.!?]+){patterns.SPACES}", f"$1{_BREAK}")
    parts = F.transform(F.split(broken, _BREAK), lambda s: strip(F.replace(s, F.lit(_GUARD), F.lit(""))))
    return F.filter(parts, lambda s: s != "")


def locale_sentences(text: Column) -> Column:
    """Spark's own locale rules as an option; they drop punctuation."""
    return F.transform(F.sentences(text), lambda words: F.array_join(words, " "))


def word_ngrams(tokens: Column, low: int, high: int, joiner: str = " ") -> Column:
    """Adjacent word n-grams of every size from low to high.

    Each size grows from the previous one by the word that follows, one concatenation per n-gram.
    """

    def grow(t: Column) -> Column:
        grams, sizes = t, []
        for n in range(1, high + 1):
            if n > 1:
                left = F.greatest(F.size(t) - (n - 1), F.lit(0))
                grams = F.zip_with(
                    F.slice(grams, 1, left), F.slice(t, n, left), lambda a, b: F.concat(a, F.lit(joiner), b)
                )
            if n >= low:
                sizes.append(grams)
        return F.concat(*sizes)

    return bind(tokens, grow)


def sentence_ngrams(text: Column, tokenizer: Tokenizer, low: int, high: int, joiner: str = " ") -> Column:
    """Word n-grams that stay inside one sentence."""
    return F.flatten(F.transform(sentences(text), lambda s: word_ngrams(tokenizer(s), low, high, joiner)))


def slices(text: Column, n: int) -> Column:
    """Every substring of n characters, overlapping.

    A lookahead captures n characters at each one consumed, so the text is walked once; substring(text, i, n)
    would count characters from the start for every i.
    """
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))


def char_ngrams(text: Column, low: int, high: int, lowercase: bool = True) -> Column:
    """Character n-grams over the whole text after squeezing white-space runs of two or more."""
    flat = F.regexp_replace(F.lower(text) if lowercase else text, rf"[{patterns.SPACE_CHARS}]{{2,}}", " ")
    return bind(flat, lambda s: F.concat(*[slices(s, n) for n in range(low, high + 1)]))


def char_wb_ngrams(text: Column, low: int, high: int, lowercase: bool = True) -> Column:
    """Character n-grams inside words padded with one space each side; a short word yields itself once."""
    lowered = F.lower(text) if lowercase else text
    if low == high and low >= 3:
        return _char_wb_of_one_size(lowered, low)
    flat = F.regexp_replace(lowered, rf"[{patterns.SPACE_CHARS}]{{2,}}", " ")
    words = F.filter(F.split(flat, patterns.SPACES), lambda w: w != "")

    def grams(padded: Column) -> Column:
        parts = []
        for n in range(low, high + 1):
            whole = slices(padded, n)
            if n == low:
                whole = F.when(F.length(padded) < n, F.array(padded)).otherwise(whole)
            parts.append(whole)
        return F.concat(*parts)

    return F.flatten(F.transform(words, lambda w: bind(F.concat(F.lit(" "), w, F.lit(" ")), grams)))


def _char_wb_of_one_size(text: Column, n: int) -> Column:
    """One walk over the text: neighbouring words share the space between them, and a gram has none but at its ends."""
    inner = rf"[^{patterns.SPACE_CHARS}]"
    short = rf"| {inner}{{1,{n - 3}}} " if n > 3 else ""
    flat = F.concat(F.lit(" "), F.regexp_replace(text, patterns.SPACES, " "), F.lit(" "))
    return F.regexp_extract_all(flat, F.lit(rf"(?s)(?=(.{inner}{{{n - 2}}}.{short}))."), F.lit(1))
