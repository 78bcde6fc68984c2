"""Label paths, derived categories and rule classifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textspark.functions import patterns
from textspark.functions.arrays import bind

PATH_SEPARATOR = " > "


def label_path(labels: Column, level: int | None) -> Column:
    """First level+1 labels joined root to leaf; -1 takes every level, None leaves the array alone."""
    if level is None:
        return labels
    taken = labels if level == -1 else F.slice(labels, 1, level + 1)
    return F.array_join(taken, PATH_SEPARATOR)


def top_label(path: Column) -> Column:
    return F.split(path, PATH_SEPARATOR)[0]


def full_text(*parts: Column, separator: str = "\n\n") -> Column:
    return F.concat_ws(separator, *parts)


def prefix_category(text: Column, rules: Mapping[str, str]) -> Column:
    """Category of the last prefix that fits, as successive masked assignments give; null when none does."""
    out = F.lit(None).cast("string")
    for prefix, category in rules.items():
        out = F.when(F.startswith(text, F.lit(prefix)), F.lit(category)).otherwise(out)
    return out


def starts_with_pattern(text: Column, pattern: str) -> Column:
    return text.rlike(f"^(?:{pattern})")


def first_match(text: Column, pattern: str) -> Column:
    """The first hit, or null; an empty hit counts as none."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def allowed_name(name: Column, literals: Iterable[str] = (), anchored: Iterable[str] = ()) -> Column:
    """False for names on the skip list: equal to a literal, or matching a pattern from the start."""
    skip = F.lit(False)
    literals = list(literals)
    if literals:
        skip = skip | name.isin(literals)
    for pattern in anchored:
        skip = skip | starts_with_pattern(name, pattern)
    return ~skip


def rule_class(predicate: Column, names: Sequence[str]) -> Column:
    """names[1] where the predicate holds, names[0] elsewhere."""
    return F.when(predicate, F.lit(names[1])).otherwise(F.lit(names[0]))


def line_class(x: Column, y: Column, slope: float, intercept: float, names: Sequence[str]) -> Column:
    """names[1] for points below the line slope*x + intercept."""
    return rule_class(F.lit(slope) * x + F.lit(intercept) > y, names)


def text_features(text: Column) -> Column:
    """Struct of length and the shares of shouting words, punctuation and digits per word."""

    def features(words: Column) -> Column:
        n = F.size(words).cast("double")
        caps = F.size(F.filter(words, lambda w: w.rlike(patterns.CAPS_WORD)))
        punct = F.regexp_count(text, F.lit(rf"[^{patterns.WORD_CHARS}{patterns.SPACE_CHARS}]"))
        digits = F.regexp_count(text, F.lit(r"\p{Nd}"))
        return F.struct(
            F.length(text).cast("long").alias("n_chars"),
            F.size(words).cast("long").alias("n_words"),
            F.try_divide(caps.cast("double"), n).alias("caps_share"),
            F.try_divide(punct.cast("double"), n).alias("punct_share"),
            F.try_divide(digits.cast("double"), n).alias("digit_share"),
        )

    return bind(F.regexp_extract_all(text, F.lit(patterns.WORD), F.lit(0)), features)
