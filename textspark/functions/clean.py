"""Text cleaners. Each maps a string Column to a string Column; null in, null out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions import patterns

Cleaner = Callable[[Column], Column]
Replacements = Mapping[str, str] | Iterable[tuple[str, str]]


def _pairs(replacements: Replacements) -> list[tuple[str, str]]:
    return list(replacements.items() if isinstance(replacements, Mapping) else replacements)


def _grouped(replacements: Replacements) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for source, target in _pairs(replacements):
        groups.setdefault(target, []).append(source)
    return groups


def replace_keywords(text: Column, replacements: Replacements, case_sensitive: bool = False) -> Column:
    """Whole-word keyword replacement: longest keyword first, left to right, output never rescanned.

    The text is cut into keyword hits, word runs and gaps in one regex pass. The word-run branch swallows
    words that merely start with a keyword, so no left boundary test is needed.
    """
    fold = (lambda s: s) if case_sensitive else str.lower
    table = {fold(k): v for k, v in _pairs(replacements)}
    if not table:
        return text
    starts_in_word = all(k[0].isalnum() or k[0] == "_" for k in table)
    gap = patterns.NON_WORD + ("+" if starts_in_word else "")
    hits = "|".join(patterns.quote(k) for k in sorted(table, key=lambda k: (-len(k), k)))
    flags = "(?s)" if case_sensitive else "(?siu)"
    pattern = rf"{flags}(?:{hits})(?![{patterns.WORD_CHARS}])|{patterns.WORD}|{gap}"

    def swap(piece: Column) -> Column:
        key = piece if case_sensitive else F.lower(piece)
        out = piece
        for target, sources in _grouped(table).items():
            out = F.when(key.isin(sources), F.lit(target)).otherwise(out)
        return out

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), swap), "")


def replace_patterns(text: Column, replacements: Replacements, case_sensitive: bool = False) -> Column:
    """Regex replacement. Patterns sharing a target become one alternation; later targets see earlier output."""
    flags = "" if case_sensitive else "(?iu)"
    return reduce(
        lambda c, group: F.regexp_replace(
            c, f"{flags}(?:{'|'.join(group[1])})", patterns.java_replacement(group[0])
        ),
        _grouped(replacements).items(),
        text,
    )


def remove_stopwords(text: Column, stopwords: Iterable[str], case_sensitive: bool = False) -> Column:
    """Each stop word becomes one space."""
    return replace_keywords(text, [(w, " ") for w in stopwords], case_sensitive)


def remove_stop_patterns(text: Column, stop_patterns: Iterable[str], case_sensitive: bool = False) -> Column:
    return replace_patterns(text, [(p, " ") for p in stop_patterns], case_sensitive)


def strip_punctuation(text: Column) -> Column:
    return remove_stop_patterns(text, [patterns.NON_WORD])


def lowercase(text: Column) -> Column:
    return F.lower(text)


def squeeze_whitespace(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, patterns.SPACES, " "))


def strip(text: Column) -> Column:
    """Drop white space at both ends, the Unicode kinds included."""
    return F.regexp_replace(text, rf"^{patterns.SPACES}|{patterns.SPACES}$", "")


def tidy_body(text: Column) -> Column:
    """Strip, then turn any gap holding three or more line ends in a row into one blank line."""
    space = f"[{patterns.SPACE_CHARS}]*"
    return F.regexp_replace(strip(text), rf"{space}\n{{3,}}{space}", "\n\n")


def mask_urls(text: Column, mask: str = "[URL BLOCKED]") -> Column:
    return F.regexp_replace(text, patterns.URL, patterns.quote_replacement(mask))


def replace_by_function(text: Column, pattern: str, fn: Cleaner) -> Column:
    """Rewrite every hit of `pattern` (which must not match the empty string) with `fn(hit)`."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s){pattern}|."), F.lit(0))
    return F.array_join(
        F.transform(pieces, lambda p: F.when(p.rlike(f"^(?:{pattern})$"), fn(p)).otherwise(p)), ""
    )


def mark_matches(
    text: Column, word: str, is_pattern: bool = False, left: str = "«", right: str = "»"
) -> Column:
    pattern = word if is_pattern else patterns.quote(word)
    mark = patterns.quote_replacement(left) + "$0" + patterns.quote_replacement(right)
    return F.regexp_replace(text, pattern, mark)


def chain(*cleaners: Cleaner) -> Cleaner:
    """Apply cleaners one after the other."""
    return lambda text: reduce(lambda c, clean: clean(c), cleaners, text)


def clean_columns(df: DataFrame, columns: Iterable[str], cleaner: Cleaner) -> DataFrame:
    """Clean several columns of a frame, cell by cell; columns that are not strings pass through."""
    strings = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns({c: cleaner(F.col(c)) for c in columns if c in strings})
