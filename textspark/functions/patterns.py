"""Regular-expression constants. Java's \\w, \\s and \\b are ASCII-minded, so classes are spelled out."""

from __future__ import annotations

import re

WORD_CHARS = r"\p{L}\p{N}_"
WORD = rf"[{WORD_CHARS}]+"
WORD_2PLUS = rf"[{WORD_CHARS}]{{2,}}"
NON_WORD = rf"[^{WORD_CHARS}]"
ALNUM = r"[\p{L}\p{N}]+"
# Unicode white space, as str.split() sees it.
SPACE_CHARS = r"\s\x1c-\x1f\x85\p{Z}"
SPACES = rf"[{SPACE_CHARS}]+"
WORD_OR_SYMBOLS = rf"{WORD}|[^{WORD_CHARS}{SPACE_CHARS}]+"
URL = r"https?://\S+"
CAPS_WORD = r"^\p{Lu}{2,}$"

_META = re.compile(r"([\\.\[\]{}()*+\-?^$|&~#])")


def quote(literal: str) -> str:
    """A pattern matching `literal` itself, valid in Java's regex engine and in RE2."""
    return _META.sub(r"\\\1", literal)


def quote_replacement(literal: str) -> str:
    """A Java replacement string that yields `literal` itself."""
    return literal.replace("\\", "\\\\").replace("$", "\\$")


_BACKREF = re.compile(r"\\(?:g<(\d+)>|(\d{1,2})|(.))", re.S)


def java_replacement(python_template: str) -> str:
    r"""Translate a replacement written with \1 or \g<1> to Java's $1, escaping $ and \."""
    out, at = [], 0
    for hit in _BACKREF.finditer(python_template):
        out.append(quote_replacement(python_template[at : hit.start()]))
        group = hit.group(1) or hit.group(2)
        if group is not None:
            out.append(f"${group}")
        else:
            escapes = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\"}
            out.append(quote_replacement(escapes.get(hit.group(3), "\\" + hit.group(3))))
        at = hit.end()
    out.append(quote_replacement(python_template[at:]))
    return "".join(out)
