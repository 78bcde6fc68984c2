"""Scans, projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from textspark.catalog.fixtures import DOCS_SQL, W, WS, documents, pages, r6, s6, table, word_vectors, VECTORS_SQL
from textspark.catalog.registry import query
from textspark.functions import labels
from textspark.operators.hierarchy import deep_tree_paths, tree_depths, tree_paths
from textspark.operators.sampling import head
from textspark.plans import shared_dir
from textspark.plans.union import union_rows
from textspark.sources import pages as page_source
from textspark.sources import posts as post_source


@query(
    "corpus_load",
    rf"""WITH {DOCS_SQL} SELECT doc_id, title, lang || ' > ' || source AS label,
    title || chr(10) || chr(10) || body AS text FROM docs""",
)
def corpus_load(spark, sf):
    posts = post_source.with_label(documents(spark, sf), -1)
    return posts.select(
        "doc_id", "title", "label", labels.full_text(F.col("title"), F.col("body")).alias("text")
    )


@query(
    "append_roundtrip",
    rf"""WITH {DOCS_SQL} SELECT doc_id AS topic_id, title, body, lang || ' > ' || source AS label FROM docs""",
)
def append_roundtrip(spark, sf):
    """Two batches of JSON lines; the second is found by reading the ledger of the first."""
    path = shared_dir(spark, "posts")
    now = F.lit("2024-01-01T00:00:00+00:00")
    posts = documents(spark, sf).select(
        F.col("doc_id").alias("topic_id"), now.alias("create_time"), F.lit("").alias("author"),
        "title", "body", "labels", now.alias("scrape_time"),
    )
    labelled = table(spark, sf, "labels").select(F.col("doc_id").alias("topic_id"))
    post_source.append_posts(posts.join(labelled, "topic_id", "left_semi"), path, "json")
    ledger = post_source.read_ledger(spark, path, "json")
    post_source.append_posts(posts.join(ledger, "topic_id", "left_anti"), path, "json")
    return post_source.read_posts(spark, path, -1).select("topic_id", "title", "body", "label")


@query(
    "id_ledger",
    "SELECT doc_id AS topic_id FROM labels",
)
def id_ledger(spark, sf):
    """The text form of the ledger, written and read back."""
    path = shared_dir(spark, "ledger")
    post_source.write_id_file(table(spark, sf, "labels").select(F.col("doc_id").alias("topic_id")), path)
    return post_source.read_id_file(spark, path)


@query(
    "dump_scan",
    rf"""WITH {DOCS_SQL} SELECT doc_id::VARCHAR AS id, '/' || lang || '/' || doc_id AS url, title, text FROM docs""",
)
def dump_scan(spark, sf):
    """Articles in nested folders, found by file name."""
    path = shared_dir(spark, "dump")
    docs = documents(spark, sf)
    key = F.col("doc_id").cast("string")
    articles = docs.select(
        key.alias("id"), F.concat(F.lit("/"), "lang", F.lit("/"), key).alias("url"), "title", "text",
        F.col("lang").alias("folder"), F.col("source").alias("part"),
    )
    articles.write.partitionBy("folder", "part").json(path)
    return post_source.read_dump(spark, path, "part-*")


@query(
    "embedding_load",
    rf"""WITH {VECTORS_SQL} SELECT word, (generate_subscripts(embedding, 1) - 1)::BIGINT AS dim,
    {s6("unnest(embedding)")} AS value FROM emb""",
)
def embedding_load(spark, sf):
    """Word vectors as text lines, written and read back."""
    path = shared_dir(spark, "vectors")
    vectors = word_vectors(spark, sf)
    values = F.array_join(F.transform("embedding", lambda x: x.cast("string")), " ")
    vectors.select(F.concat_ws(" ", "word", values).alias("value")).write.text(path)
    loaded = post_source.read_embedding_text(spark, path, 64)
    return loaded.select("word", F.posexplode("embedding").alias("dim", "v")).select(
        "word", F.col("dim").cast("bigint").alias("dim"), r6(F.col("v").cast("double")).alias("value")
    )


def _sql_tidy(expr: str) -> str:
    stripped = rf"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"
    return rf"regexp_replace({stripped}, '{WS}*\n{{3,}}{WS}*', chr(10) || chr(10), 'g')"


def _sql_decode(expr: str) -> str:
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", "\xa0"), ("copy", "\xa9"), ("mdash", "\u2014"), ("amp", "&")):
        expr = f"replace({expr}, '&{name};', '{char}')"
    return expr


_NO_BLOCKS = r"""regexp_replace(regexp_extract(html, '(?is)<article(?:\s[^>]*)?>(.*?)</article>', 1), '(?s)<!--.*?-->', '', 'g')"""
for _tag in ("div", "table", "script", "style", "b", "i", "code", "pre", "blockquote"):
    _NO_BLOCKS = rf"regexp_replace({_NO_BLOCKS}, '(?is)<{_tag}(?:\s[^>]*)?>.*?</{_tag}>', '', 'g')"
_BODY_SQL = _sql_tidy(
    _sql_decode(rf"regexp_replace(regexp_replace({_NO_BLOCKS}, '(?i)<br\s*/?>', chr(10), 'g'), '(?s)<[^>]*>', '', 'g')")
)
_TITLE_SQL = (
    rf"regexp_replace({_sql_decode('regexp_replace(' + chr(10) + r'''regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1>', 1), '(?s)<[^>]*>', '', 'g')''')}"
    rf", '^{WS}+|{WS}+$', '', 'g')"
)
_PATH_NUMBER_SQL = r"""nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^.*/(\d+)(?:/[^/]*)?$', 1), '')::BIGINT"""
_HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)"
_POSTS_SQL = f"""posts AS (SELECT page_id, {_PATH_NUMBER_SQL} AS topic_id, {_HOST_SQL} AS host,
    {_TITLE_SQL} AS title, {_BODY_SQL} AS body FROM pages)"""


@query("page_posts", f"WITH {_POSTS_SQL} SELECT page_id, topic_id, host, title, body FROM posts")
def page_posts(spark, sf):
    return page_source.page_posts(pages(spark, sf))


@query(
    "page_quality",
    f"""WITH {_POSTS_SQL} SELECT host, count(*) AS n_pages, count(*) FILTER (title = '') AS n_no_title,
    count(*) FILTER (body = '') AS n_no_body, sum(length(body))::BIGINT AS n_chars FROM posts GROUP BY host""",
)
def page_quality(spark, sf):
    return page_source.host_quality(page_source.page_posts(pages(spark, sf)))


@query(
    "url_ids",
    rf"""SELECT page_id, {_PATH_NUMBER_SQL} AS topic_id,
    nullif(regexp_extract(url, 'page=(\d+)', 1), '')::BIGINT AS page_no FROM pages""",
)
def url_ids(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", page_source.path_number(url).alias("topic_id"), page_source.query_id(url, "page").alias("page_no")
    )


@query(
    "label_path",
    "SELECT doc_id, lang AS level0, lang || ' > ' || source AS level1, lang || ' > ' || source AS every FROM documents",
)
def label_path(spark, sf):
    docs = documents(spark, sf)
    depths = {"level0": 0, "level1": 1, "every": -1}
    return docs.select("doc_id", *[labels.label_path(F.col("labels"), d).alias(n) for n, d in depths.items()])


@query(
    "full_text",
    rf"""WITH {DOCS_SQL} SELECT doc_id, title || chr(10) || chr(10) || body AS text,
    title || '. ' || body AS dotted FROM docs""",
)
def full_text(spark, sf):
    parts = F.col("title"), F.col("body")
    return documents(spark, sf).select(
        "doc_id", labels.full_text(*parts).alias("text"), labels.full_text(*parts, separator=". ").alias("dotted")
    )


@query("top_label", "SELECT doc_id, lang AS top FROM documents")
def top_label(spark, sf):
    posts = post_source.with_label(documents(spark, sf), -1)
    return posts.select("doc_id", labels.top_label(F.col("label")).alias("top"))


@query("label_isin", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de')")
def label_isin(spark, sf):
    return table(spark, sf, "documents").filter(F.col("lang").isin("en", "de")).select("doc_id", "lang")


@query(
    "prefix_category",
    """SELECT conv_id, turn, CASE WHEN starts_with(role, 'assist') THEN 'answer'
    WHEN starts_with(role, 'us') THEN 'question' END AS category FROM conversations""",
)
def prefix_category(spark, sf):
    category = labels.prefix_category(F.col("role"), {"us": "question", "assist": "answer"})
    return table(spark, sf, "conversations").select("conv_id", "turn", category.alias("category"))


@query(
    "regex_search",
    """SELECT doc_id, nullif(regexp_extract(text, 'on[a-z]+re', 0), '') AS hit,
    regexp_matches(text, '^(?:[A-Z][a-z]+ [a-z]+)') AS at_start
    FROM documents WHERE regexp_matches(text, 'on[a-z]+re')""",
)
def regex_search(spark, sf):
    text = F.col("text")
    return (
        documents(spark, sf)
        .filter(text.rlike("on[a-z]+re"))
        .select(
            "doc_id",
            labels.first_match(text, "on[a-z]+re").alias("hit"),
            labels.starts_with_pattern(text, "[A-Z][a-z]+ [a-z]+").alias("at_start"),
        )
    )


@query(
    "skip_names",
    r"SELECT doc_id, source FROM documents WHERE NOT (source = 'src3' OR regexp_matches(source, '^(?:src1\d$)'))",
)
def skip_names(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return docs.filter(labels.allowed_name(F.col("source"), ["src3"], [r"src1\d$"]))


@query(
    "rule_label",
    "SELECT p_partkey, CASE WHEN p_size > p_retailprice / 100 THEN 'wide' ELSE 'high' END AS cls FROM part",
)
def rule_label(spark, sf):
    wider = F.col("p_size") > F.col("p_retailprice") / 100
    return table(spark, sf, "part").select("p_partkey", labels.rule_class(wider, ["high", "wide"]).alias("cls"))


@query(
    "line_label",
    """SELECT p_partkey, CASE WHEN 0.5::DOUBLE * p_size + 3.0::DOUBLE > p_retailprice / 100 THEN 'below' ELSE 'above' END AS cls
    FROM part""",
)
def line_label(spark, sf):
    cls = labels.line_class(F.col("p_size"), F.col("p_retailprice") / 100, 0.5, 3.0, ["above", "below"])
    return table(spark, sf, "part").select("p_partkey", cls.alias("cls"))


@query("head_n", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def head_n(spark, sf):
    return head(table(spark, sf, "documents").select("doc_id", "lang", "source"), [F.col("doc_id")], 5)


@query(
    "text_features",
    rf"""WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '{W}+') AS words FROM documents)
    SELECT doc_id, length(text)::BIGINT AS n_chars, len(words)::BIGINT AS n_words,
    {s6(r"len(list_filter(words, lambda x: regexp_full_match(x, '\p{Lu}{2,}')))::DOUBLE / nullif(len(words), 0)")} AS caps_share,
    {s6(rf"len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}_\s\x1c-\x1f\x85\p{{Z}}]'))::DOUBLE / nullif(len(words), 0)")} AS punct_share,
    {s6(r"len(regexp_extract_all(text, '\p{Nd}'))::DOUBLE / nullif(len(words), 0)")} AS digit_share FROM w""",
)
def text_features(spark, sf):
    f = documents(spark, sf).select("doc_id", labels.text_features(F.col("text")).alias("f")).select("doc_id", "f.*")
    return f.withColumns({c: r6(c) for c in ("caps_share", "punct_share", "digit_share")})


@query("distinct_labels", "SELECT DISTINCT lang, source FROM documents")
def distinct_labels(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").distinct()


TREE_SQL = """WITH RECURSIVE nodes AS (
      SELECT 'r' || r_regionkey AS node_id, NULL AS parent_id, r_name AS name FROM region
      UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
      UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
    ok AS (SELECT * FROM nodes WHERE NOT (name = 'ASIA' OR regexp_matches(name, '^(?:.*Y$)'))),
    tree AS (SELECT node_id, name AS path, 1 AS depth FROM ok WHERE parent_id IS NULL
      UNION ALL SELECT o.node_id, t.path || ' > ' || o.name, t.depth + 1 FROM ok o JOIN tree t ON o.parent_id = t.node_id)
    SELECT node_id, path, depth::BIGINT AS depth FROM tree"""


def _places(spark, sf):
    """Regions, nations and customers as one tree."""
    def rows(name, prefix, key, parent_prefix, parent, label):
        up = F.concat(F.lit(parent_prefix), F.col(parent)) if parent else F.lit(None).cast("string")
        return table(spark, sf, name).select(
            F.concat(F.lit(prefix), F.col(key)).alias("node_id"), up.alias("parent_id"), F.col(label).alias("name")
        )

    return union_rows(
        rows("region", "r", "r_regionkey", "", None, "r_name"),
        rows("nation", "n", "n_nationkey", "r", "n_regionkey", "n_name"),
        rows("customer", "c", "c_custkey", "n", "c_nationkey", "c_name"),
    )


@query("tree_paths", TREE_SQL)
def tree_paths_query(spark, sf):
    return tree_paths(_places(spark, sf), labels.allowed_name(F.col("name"), ["ASIA"], [".*Y$"]))


@query("deep_tree_paths", TREE_SQL)
def deep_tree_paths_query(spark, sf):
    return deep_tree_paths(_places(spark, sf), labels.allowed_name(F.col("name"), ["ASIA"], [".*Y$"]))


@query(
    "tree_depths",
    """WITH RECURSIVE nodes AS (
      SELECT DISTINCT conv_id || ':' || turn AS node_id, CASE WHEN turn > 0 THEN conv_id || ':' || (turn - 1) END AS parent_id FROM conversations
      UNION ALL SELECT 'd' || doc_id, CASE WHEN doc_id % 500 > 0 THEN 'd' || (doc_id - 1) END FROM (SELECT DISTINCT doc_id FROM documents)),
    tree AS (SELECT node_id, node_id AS root_id, 1 AS depth FROM nodes WHERE parent_id IS NULL
      UNION ALL SELECT n.node_id, t.root_id, t.depth + 1 FROM nodes n JOIN tree t ON n.parent_id = t.node_id)
    SELECT node_id, root_id, depth::BIGINT AS depth FROM tree""",
)
def tree_depths_query(spark, sf):
    """Turns answer the turn before, and documents continue the one before in threads of up to 500."""
    turn, doc = F.col("turn"), F.col("doc_id")
    turns = table(spark, sf, "conversations").select(
        F.concat("conv_id", F.lit(":"), turn).alias("node_id"), F.when(turn > 0, F.concat("conv_id", F.lit(":"), turn - 1)).alias("parent_id")
    )
    threads = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), doc).alias("node_id"), F.when(doc % 500 > 0, F.concat(F.lit("d"), doc - 1)).alias("parent_id")
    )
    return tree_depths(union_rows(turns.distinct(), threads.distinct()))
