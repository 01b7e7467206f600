"""HTML of tables that can be shown: what is kept, and where tables lie in a text.

Each text is read once from left to right, by a state machine whose steps never look at a character twice for an element that isn't closed; so the time is linear in
the text, whatever it holds. Null stays null, and an empty text is empty.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: tags that stay, and elements that go with all they hold
KEPT_TAGS = ("table", "thead", "tbody", "tr", "th", "td", "br", "strong", "em", "b", "i")
DROPPED = ("script", "style")

# texts that Python holds at a time
SLICE = 32

_TAG = re.compile(r"</?\s*([a-zA-Z][a-zA-Z0-9]*)\b")


def elements(text: str, names: tuple[str, ...]) -> Iterator[tuple[int, int]]:
    """Where elements of these names begin and end: from an opening to the next closing tag of its name. What isn't closed is no element."""
    opening = re.compile(rf"<\s*({'|'.join(names)})\b", re.IGNORECASE)
    closing = {n: re.compile(rf"<\s*/\s*{n}\s*>", re.IGNORECASE) for n in names}
    at = 0
    while closing and (m := opening.search(text, at)):
        at, name = m.end(), m[1].lower()
        if name in closing:
            if end := closing[name].search(text, at):
                at = end.end()
                yield m.start(), at
            else:  # nothing further on closes this name
                del closing[name]


def tags(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(begin, end, name, closing) of each tag; one without its last bracket is text."""
    at = 0
    while m := _TAG.search(text, at):
        end = text.find(">", m.end())
        if end < 0:
            return
        at = end + 1
        yield m.start(), at, m[1].lower(), text[m.start() + 1] == "/"


def _shown(text: str) -> str:
    parts, at = [], 0
    for begin, end in elements(text, DROPPED):
        parts.append(text[at:begin])
        at = end
    text, out, at = "".join([*parts, text[at:]]), [], 0
    for begin, end, name, closing in tags(text):
        out.append(html.escape(text[at:begin], quote=False))
        if name in KEPT_TAGS:
            out.append("<br/>" if name == "br" else f"</{name}>" if closing else f"<{name}>")
        at = end
    return "".join([*out, html.escape(text[at:], quote=False)])


def _parts(text: str) -> list[dict[str, str]]:
    out, at = [], 0
    for begin, end in elements(text, ("table",)):
        out += [{"kind": "text", "text": text[at:begin]}] if begin > at else []
        out.append({"kind": "table", "text": text[begin:end]})
        at = end
    return out + ([{"kind": "text", "text": text[at:]}] if at < len(text) else [])


def _by_slices(c: pa.Array, of: Callable[[str], object], kind: pa.DataType) -> pa.Array:
    """of each text, null for null. A batch is looked at SLICE texts at a time, so that Python never holds the texts of a whole batch, only Arrow does."""
    out = []
    for at in range(0, len(c), SLICE):
        out.append(pa.array([None if t is None else of(t) for t in c.slice(at, SLICE).to_pylist()], kind))
    return pa.concat_arrays(out) if out else pa.array([], kind)


_PARTS = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))


def _sanitized(c: pa.Array) -> pa.Array:
    return _by_slices(c, _shown, pa.string())


def _segments(c: pa.Array) -> pa.Array:
    return _by_slices(c, _parts, _PARTS)


def sanitized(c: Column) -> Column:
    """The text with the tags of tables and of emphasis, bare of attributes; other tags go, scripts and styles with what they hold, and all else is escaped."""
    return F.arrow_udf(_sanitized, "string")(c)


def segments(c: Column) -> Column:
    """Array of (kind, text): tables as they stand, each up to its first closing tag, and the texts between them; put together they are the whole text."""
    return F.arrow_udf(_segments, "array<struct<kind:string,text:string>>")(c)
