"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.catalog.fixtures import (
    DOCS_SQL, NW, RAW, STOP_SQL, W, WS, documents, pages, stop_list,
)
from textspark.catalog.columns import _sql_tidy
from textspark.catalog.registry import query
from textspark.functions import clean, patterns
from textspark.functions.tokens import ABBREVIATIONS, raw_tokens, word_tokens
from textspark.operators import keywords, lexicon
from textspark.operators.corpus import word_counts
from textspark.operators.sparse import bag_of_words
from textspark.plans import durable

KEYWORDS = {"The": "THAT", "of": "from", "la": "", "und": "& $1", "que": "que que"}
_KEYWORD_CASES = " ".join(f"WHEN '{k.lower()}' THEN '{v}'" for k, v in KEYWORDS.items())


def cleaned(spark, sf, cleaner):
    return documents(spark, sf).select("doc_id", cleaner(F.col("text")).alias("text"))


@query(
    "keyword_replace",
    rf"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '{W}+|{NW}+'),
    lambda x: CASE lower(x) {_KEYWORD_CASES} ELSE x END), '') AS text FROM documents""",
)
def keyword_replace(spark, sf):
    return cleaned(spark, sf, lambda c: clean.replace_keywords(c, KEYWORDS))


_TERMS = f"""tok AS (SELECT unnest(regexp_extract_all(lower(text), '{W}+')) AS term FROM documents),
    terms AS (SELECT term FROM tok WHERE length(term) > 2 GROUP BY term HAVING count(*) > 1)"""


def _table_sql(target: str) -> str:
    """Every piece of a text that is in `terms` becomes `target`."""
    return f"""WITH {_TERMS},
    pieces AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{W}+|{NW}+') AS p FROM documents)),
    changed AS (SELECT doc_id, string_agg(CASE WHEN term IS NULL THEN piece ELSE {target} END, '' ORDER BY i) AS text
      FROM pieces LEFT JOIN terms ON term = lower(piece) GROUP BY doc_id)
    SELECT doc_id, coalesce(c.text, d.text) AS text FROM documents d LEFT JOIN changed c USING (doc_id)"""


def _term_table(spark, sf):
    """A dictionary that grows with the corpus: every word of three letters and more that occurs twice."""
    counts = word_counts(documents(spark, sf), raw_tokens(F.col("text")))
    return counts.filter((F.col("n") > 1) & (F.length("term") > 2)).select(F.col("term").alias("keyword"))


@query("keyword_table", _table_sql("concat('k', substr(md5(term), 1, 6))"))
def keyword_table(spark, sf):
    terms = _term_table(spark, sf).withColumn("replacement", F.concat(F.lit("k"), F.substring(F.md5("keyword"), 1, 6)))
    return keywords.replace_from_table(documents(spark, sf).select("doc_id", "text"), "text", terms)


@query("stopword_table", _table_sql("' '"))
def stopword_table(spark, sf):
    return keywords.remove_from_table(documents(spark, sf).select("doc_id", "text"), "text", _term_table(spark, sf))


@query(
    "regex_replace",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '(?:tion|ing)', 'TION', 'gi'),
    '(?:T(h)(e)r)', '<\1-\2>', 'gi'), '(?:TIONe)', 'later', 'gi') AS text FROM documents""",
)
def regex_replace(spark, sf):
    rules = [("tion", "TION"), ("T(h)(e)r", r"<\1-\2>"), ("ing", "TION"), ("TIONe", "later")]
    return cleaned(spark, sf, lambda c: clean.replace_patterns(c, rules))


@query(
    "stopword_clean",
    rf"""WITH {STOP_SQL}, s AS (SELECT list(term) AS terms FROM stop)
    SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '{W}+|{NW}+'),
    lambda x: CASE WHEN list_contains(terms, lower(x)) THEN ' ' ELSE x END), '') AS text FROM documents, s""",
)
def stopword_clean(spark, sf):
    words = stop_list(spark, sf)
    return cleaned(spark, sf, lambda c: clean.remove_stopwords(c, words))


@query(
    "regex_stopword",
    r"""SELECT doc_id, regexp_replace(text, '(?:the\p{L}*|eau|\d+)', ' ', 'gi') AS text FROM documents""",
)
def regex_stopword(spark, sf):
    return cleaned(spark, sf, lambda c: clean.remove_stop_patterns(c, [r"the\p{L}*", "eau", r"\d+"]))


@query("lowercase", "SELECT doc_id, lower(text) AS text FROM documents")
def lowercase(spark, sf):
    return cleaned(spark, sf, clean.lowercase)


@query("squeeze_ws", rf"SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS text FROM documents")
def squeeze_ws(spark, sf):
    return cleaned(spark, sf, clean.squeeze_whitespace)


@query(
    "tidy_body",
    rf"""WITH {DOCS_SQL} SELECT doc_id,
    {_sql_tidy("replace(body, '.' || chr(10), ' ' || chr(10) || chr(10) || chr(10) || ' ')")} AS text FROM docs""",
)
def tidy_body(spark, sf):
    gaps = F.replace("body", F.lit(".\n"), F.lit(" \n\n\n "))
    return documents(spark, sf).select("doc_id", clean.tidy_body(gaps).alias("text"))


@query(
    "mask_urls",
    r"""SELECT page_id, regexp_replace(url || ' ' || html, 'https?://\S+', '[URL BLOCKED]', 'g') AS html FROM pages""",
)
def mask_urls(spark, sf):
    both = F.concat_ws(" ", "url", "html")
    return pages(spark, sf).select("page_id", clean.mask_urls(both).alias("html"))


@query("replace_fn", "SELECT doc_id, replace(text, 'ha', 'HA') AS text FROM documents")
def replace_fn(spark, sf):
    return cleaned(spark, sf, lambda c: clean.replace_by_function(c, "ha", F.upper))


@query(
    "mark_matches",
    r"""SELECT doc_id, replace(text, 'the.', '«the.»') AS literal,
    regexp_replace(text, '([A-Z][a-z]+)', '«\1»', 'g') AS pattern FROM documents""",
)
def mark_matches(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "doc_id",
        clean.mark_matches(text, "the.").alias("literal"),
        clean.mark_matches(text, "[A-Z][a-z]+", is_pattern=True).alias("pattern"),
    )


@query("strip_punct", rf"SELECT doc_id, regexp_replace(text, '{NW}', ' ', 'g') AS text FROM documents")
def strip_punct(spark, sf):
    return cleaned(spark, sf, clean.strip_punctuation)


@query(
    "synonym_fold",
    rf"""SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
    lower(regexp_replace(text, '(?:of the|de la|in der)', 'ofthe', 'gi')), '{W}{{2,}}')) AS term FROM documents)
    GROUP BY doc_id, term""",
)
def synonym_fold(spark, sf):
    folded = clean.replace_patterns(F.col("text"), {p: "ofthe" for p in ("of the", "de la", "in der")})
    return bag_of_words(documents(spark, sf), "doc_id", word_tokens(folded))


_ABBR = "|".join(patterns.quote(a) for a in sorted(ABBREVIATIONS, key=lambda a: (-len(a), a)))


def sql_sentences(expr: str) -> str:
    """List of sentences of a text expression."""
    guarded = rf"regexp_replace({expr}, '(?i)(^|{NW})({_ABBR})', '\1\2' || chr(2), 'g')"
    broken = rf"regexp_replace({guarded}, '([.!?]+){WS}+', '\1' || chr(1), 'g')"
    trimmed = rf"regexp_replace(replace(x, chr(2), ''), '^{WS}+|{WS}+$', '', 'g')"
    return f"list_filter(list_transform(string_split({broken}, chr(1)), lambda x: {trimmed}), lambda x: x <> '')"


_NAMES_SQL = rf"""sents AS (SELECT doc_id, unnest({sql_sentences("text")}) AS sentence FROM documents),
lists AS (SELECT regexp_extract_all(sentence, '{W}+') AS l FROM sents),
forms AS (SELECT token, count(*) AS n, count(*) FILTER (pos > 1) AS n_inside
  FROM (SELECT unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM lists) GROUP BY token),
names AS (SELECT lower(token) AS entry FROM forms GROUP BY lower(token)
  HAVING bool_or(regexp_matches(token, '^\p{{Lu}}') AND n_inside > 0) AND NOT bool_or(token = lower(token)))"""


@query(
    "lower_keep_names",
    rf"""WITH {_NAMES_SQL}, d AS (SELECT doc_id, regexp_extract_all(text, '{W}+') AS l FROM documents),
    t AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM d)
    SELECT d.doc_id, coalesce(string_agg(CASE WHEN n.entry IS NULL THEN lower(token) ELSE token END, ' ' ORDER BY pos), '') AS text
    FROM d LEFT JOIN t USING (doc_id) LEFT JOIN names n ON n.entry = lower(t.token) GROUP BY d.doc_id""",
)
def lower_keep_names(spark, sf):
    docs = documents(spark, sf)
    names = durable(lexicon.proper_names(docs, F.col("text")))
    return lexicon.join_tokens(lexicon.lower_keep_names(docs, "doc_id", F.col("text"), names), "doc_id")


_LEMMA_SQL = rf"""words AS (SELECT DISTINCT unnest({RAW}) AS term FROM documents),
lemmas AS (SELECT a.term AS entry, b.term AS lemma FROM words a JOIN words b
  ON a.term LIKE '%s' AND length(a.term) > 3 AND b.term = substr(a.term, 1, length(a.term) - 1))"""


def plural_lemmas(spark, sf):
    """(entry, replacement): words ending in s whose stem the corpus knows too."""
    words = word_counts(documents(spark, sf), raw_tokens(F.col("text"))).select("term")
    stems = words.filter(F.endswith("term", F.lit("s")) & (F.length("term") > 3)).select(
        F.col("term").alias("entry"), F.expr("substring(term, 1, length(term) - 1)").alias("term")
    )
    return durable(stems.join(words, "term").select("entry", F.col("term").alias("replacement")))


@query(
    "lemma_join",
    rf"""WITH {_LEMMA_SQL}, d AS (SELECT doc_id, {RAW} AS l FROM documents),
    t AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) AS pos FROM d)
    SELECT d.doc_id, coalesce(string_agg(coalesce(lemma, token), ' ' ORDER BY pos), '') AS text
    FROM d LEFT JOIN t USING (doc_id) LEFT JOIN lemmas n ON n.entry = t.token GROUP BY d.doc_id""",
)
def lemma_join(spark, sf):
    docs = documents(spark, sf)
    rows = lexicon.token_positions(docs, "doc_id", raw_tokens(F.col("text")))
    return lexicon.join_tokens(lexicon.rewrite_tokens(rows, plural_lemmas(spark, sf), on=lambda t: t), "doc_id")


_AFTER = rf"regexp_extract_all(lower(regexp_replace(text, '(?:tion|ing)', ' ', 'gi')), '{W}+')"
_AUDIT_SQL = rf"""before AS (SELECT doc_id, term, count(*) AS n FROM
  (SELECT doc_id, unnest({RAW}) AS term FROM documents) GROUP BY ALL),
after AS (SELECT doc_id, term, count(*) AS n FROM
  (SELECT doc_id, unnest({_AFTER}) AS term FROM documents) GROUP BY ALL),
audit AS (SELECT doc_id, term, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta
  FROM before b FULL JOIN after a USING (doc_id, term))"""


def _audit(spark, sf):
    changed = clean.remove_stop_patterns(F.col("text"), ["tion", "ing"])
    return lexicon.change_audit(documents(spark, sf), "doc_id", raw_tokens(F.col("text")), raw_tokens(changed))


@query(
    "clean_audit",
    f"WITH {_AUDIT_SQL} SELECT doc_id, term, delta::BIGINT AS delta FROM audit WHERE delta <> 0",
)
def clean_audit(spark, sf):
    return _audit(spark, sf)


@query(
    "clean_audit_terms",
    f"""WITH {_AUDIT_SQL} SELECT term, sum(greatest(-delta, 0))::BIGINT AS removed, sum(greatest(delta, 0))::BIGINT AS added
    FROM audit WHERE delta <> 0 GROUP BY term""",
)
def clean_audit_terms(spark, sf):
    return lexicon.removed_terms(_audit(spark, sf))


@query(
    "clean_audit_chars",
    """SELECT doc_id, (length(regexp_replace(text, '(?:tion|ing)', ' ', 'gi')) - length(text))::BIGINT AS char_delta
    FROM documents""",
)
def clean_audit_chars(spark, sf):
    changed = clean.remove_stop_patterns(F.col("text"), ["tion", "ing"])
    return documents(spark, sf).select(
        "doc_id", (F.length(changed) - F.length("text")).cast("bigint").alias("char_delta")
    )


@query(
    "cleaner_chain",
    rf"""WITH {DOCS_SQL}, c AS (SELECT doc_id, lower(title) AS title, lower(body) AS body FROM docs)
    SELECT doc_id, trim(regexp_replace(regexp_replace(title, '(?:[0-9]+|tion)', ' ', 'gi'), '{WS}+', ' ', 'g')) AS title,
    trim(regexp_replace(regexp_replace(body, '(?:[0-9]+|tion)', ' ', 'gi'), '{WS}+', ' ', 'g')) AS body FROM c""",
)
def cleaner_chain(spark, sf):
    cleaner = clean.chain(
        clean.lowercase, lambda c: clean.remove_stop_patterns(c, ["[0-9]+", "tion"]), clean.squeeze_whitespace
    )
    docs = documents(spark, sf).select("doc_id", "title", "body")
    return clean.clean_columns(docs, ["doc_id", "title", "body"], cleaner)
