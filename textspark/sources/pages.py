"""From stored HTML pages to posts, all in column expressions."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions.clean import strip, tidy_body
from textspark.functions.patterns import quote

# The elements whose text is kept.
KEPT_TAGS = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "strong", "a", "em", "span")
# A reference by name, by number or by hexadecimal number; other text; a bare ampersand.
_REFERENCES = r"&[A-Za-z][A-Za-z0-9]*;|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|[^&]+|&"
_ATTRIBUTES = r"(?:\s[^>]*)?"
_EDIT = r"""(?=[^>]*\sclass\s*=\s*(?:"[^"]*\bedit\b|'[^']*\bedit\b|edit\b))"""
# Elements without an end tag.
_VOID = "^(?:area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)$"
# Comments, scripts and styles with all they hold, tags (a > in quotes does not end one), and text.
_PIECES = (
    r"""(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-z][^>]*>"""
    r"""|<[!?][^>]*>|[^<]+|<"""
)
_FRAME = "struct<name:string,kind:string,item:int,own:string,whole:string>"


def query_id(url: Column, name: str = "showforum") -> Column:
    """Number behind `name=` in a URL, or null."""
    return F.nullif(F.regexp_extract(url, rf"{quote(name)}=(\d+)", 1), F.lit("")).cast("bigint")


def last_piece_id(element_id: Column, separator: str = "-") -> Column:
    """Number after the last separator of an element id, or null when it is no number."""
    return F.element_at(F.split(element_id, quote(separator)), -1).try_cast("bigint")


def path_number(url: Column) -> Column:
    """Last number that stands alone between slashes in the path of a URL."""
    path = F.regexp_replace(url, r"[?#].*$", "")
    return F.nullif(F.regexp_extract(path, r"^.*/(\d+)(?:/[^/]*)?$", 1), F.lit("")).cast("bigint")


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)


def headline(html: Column, tag: str = "h1") -> Column:
    """Text of the first element of that name."""
    inner = F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    return strip(_decode(_strip_tags(inner)))


def _strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<[^>]*>", "")


def _decode(text: Column) -> Column:
    """Character references as the characters they stand for; unknown ones stay."""
    named = F.from_json(F.lit(json.dumps({f"&{name};": chr(n) for name, n in name2codepoint.items()})), "map<string,string>")

    def character(p: Column) -> Column:
        digits = F.regexp_extract(p, "^&#[xX]?([0-9A-Fa-f]+);$", 1)
        point = F.when(p.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        valid = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(p.rlike("^&#"), char).when(p.rlike("^&.+;$"), F.coalesce(F.try_element_at(named, p), p)).otherwise(p)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_REFERENCES), F.lit(0)), character), "")


def _parsed(piece: Column) -> Column:
    """What a piece is: text, a start or an end of an element, or nothing; with the element's name and kind."""
    name = F.lower(F.regexp_extract(piece, "^</?([A-Za-z][A-Za-z0-9]*)", 1))
    kind = (
        F.when(piece.rlike(rf"(?is)^<[a-z][a-z0-9]*{_EDIT}"), "edit")
        .when(name.isin(*KEPT_TAGS), "kept").when(name.isin("ul", "ol"), "list").when(name == "br", "br").otherwise("other")
    )
    empty = name.rlike(_VOID) | piece.endswith("/>")
    what = (
        F.when(piece.rlike(r"(?i)^<(?:[!?]|(?:script|style)\b)"), "nothing")
        .when(piece.rlike("^</[A-Za-z]"), "end").when(piece.rlike("^<[A-Za-z]"), F.when(empty, "empty").otherwise("start")).otherwise("text")
    )
    return F.struct(piece.alias("text"), name.alias("name"), kind.alias("kind"), what.alias("what"))


def _state(stack: Column, items: Column, done: Column) -> Column:
    return F.struct(stack.alias("stack"), items.alias("items"), done.alias("done"))


def _frame(name: Column, kind: Column, item: Column, own: Column, whole: Column) -> Column:
    return F.struct(name.alias("name"), kind.alias("kind"), item.alias("item"), own.alias("own"), whole.alias("whole")).cast(_FRAME)


def _added(stack: Column, own: Column, whole: Column) -> Column:
    """The innermost open element with more text."""
    top = F.element_at(stack, -1)
    more = _frame(top["name"], top["kind"], top["item"], F.concat(top["own"], own), F.concat(top["whole"], whole))
    return F.concat(F.slice(stack, 1, F.size(stack) - 1), F.array(more))


def _popped(s: Column) -> Column:
    """The innermost open element ends: what it gives goes to the element around it."""
    stack, items = s["stack"], s["items"]
    top, below = F.element_at(stack, -1), F.slice(stack, 1, F.size(stack) - 1)
    inside = F.exists(below, lambda f: f["kind"] == "list")
    numbered = F.concat(F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x, F.lit("\n"))), ""), F.lit("\n"))
    own = (
        F.when(top["kind"] == "kept", F.when(top["own"] != "", top["own"]).otherwise(top["whole"]))
        .when((top["kind"] == "list") & ~inside, numbered).otherwise("")
    )
    kept = F.transform(items, lambda x, i: F.when(i == top["item"], top["whole"]).otherwise(x))
    left = F.when((top["kind"] == "list") & ~inside, F.array().cast("array<string>")).otherwise(kept)
    return _state(_added(below, own, top["whole"]), left, s["done"])


def _read(s: Column, p: Column) -> Column:
    stack, items = s["stack"], s["items"]
    in_list = F.exists(stack, lambda f: f["kind"] == "list")
    is_item = in_list & (p["name"] == "li")
    opened = _frame(p["name"], p["kind"], F.when(is_item, F.size(items)).otherwise(-1), F.lit(""), F.lit(""))
    started = _state(
        F.concat(stack, F.array(opened)), F.when(is_item, F.concat(items, F.array(F.lit("")))).otherwise(items), s["done"]
    )
    # An end tag closes the innermost open element of its name and what is open inside; without one it is nothing.
    back = F.array_position(F.reverse(F.transform(stack, lambda f: f["name"])), p["name"]).cast("int")
    last = back == F.size(stack)
    pops = F.when(last, back - 1).otherwise(back)
    shut = F.aggregate(F.when(pops > 0, F.sequence(F.lit(1), pops)).otherwise(F.array().cast("array<int>")), s, lambda t, _: _popped(t))
    text = F.when(p["what"] == "text", p["text"]).when(p["kind"] == "br", "\n").otherwise("")
    return (
        F.when(s["done"] | (p["what"] == "nothing"), s)
        .when(p["what"] == "start", started)
        .when(p["what"] == "end", F.when(last, shut.withField("done", F.lit(True))).otherwise(shut))
        .otherwise(_state(_added(stack, text, text), items, s["done"]))
    )


def body_text(html: Column, container: str = "article") -> Column:
    """Text of the first container: kept elements and lists, in column expressions, at any depth.

    Comments and elements of class `edit` go, <br> is a line end, the items of a list and of lists in it are numbered, and
    every other element goes with all it holds, unless it is all that a kept element has. Tags and text are read once,
    with the open elements on a stack.
    """
    inner = F.regexp_extract(html, rf"(?is)<{container}{_ATTRIBUTES}>(.*)", 1)
    pieces = F.transform(F.regexp_extract_all(inner, F.lit(_PIECES), F.lit(0)), _parsed)
    base = _frame(F.lit(container), F.lit("kept"), F.lit(-1), F.lit(""), F.lit(""))
    start = _state(F.array(base), F.array().cast("array<string>"), F.lit(False))
    text = F.aggregate(pieces, start, _read, lambda s: F.when(s["done"], F.element_at(s["stack"], 1)["own"]).otherwise(""))
    return tidy_body(_decode(text))


def page_posts(pages: DataFrame, container: str = "article") -> DataFrame:
    """(page_id, topic_id, host, title, body) from (page_id, url, html), all in the JVM."""
    return pages.select(
        "page_id",
        path_number(F.col("url")).alias("topic_id"),
        host(F.col("url")).alias("host"),
        headline(F.col("html")).alias("title"),
        body_text(F.col("html"), container).alias("body"),
    )


def host_quality(posts: DataFrame) -> DataFrame:
    """Per site: pages, pages without a title or a body, and body characters."""
    return posts.groupBy("host").agg(
        F.count("*").alias("n_pages"),
        F.count_if(F.coalesce("title", F.lit("")) == "").alias("n_no_title"),
        F.count_if(F.coalesce("body", F.lit("")) == "").alias("n_no_body"),
        F.sum(F.length("body")).cast("bigint").alias("n_chars"),
    )
