"""HTML extraction with site style trees.

The pages of a host are merged into one style tree: its nodes are paths of elements with their classes. Over the pages that have a node, the entropy of its
presentation (the sequences of elements it holds) and of its content (on how many pages each of its texts occurs) give its importance: a branch that looks alike
and says the same on every page comes near 0, one that differs in both near 1. Branches of low importance are removed from each page.

What an element declares itself to be (article, menu, advert ...) is a prior of less weight than the tree's range, so the tree can overrule it either way.
Reader comments and widgets alone weigh more (NEVER): a comment is as fresh as the article, which no entropy can tell.

Defined cases: null and empty pages give an empty text; pages may be of any length; the tree's say grows with the number of pages that have the node (none at
one page, half at five), so on a host of one page the priors decide; null is a host of its own; repeated rows all get their text, and pages that are alike
throughout count as few (`told_apart`), so that copies neither speak against an article nor for it; an empty table gives an empty table; other columns pass
through, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .store import stash

#: Score of a block: STEEP * (importance - NEUTRAL), from -2 to 3, by the tree's say; the priors are added. Kept at 0 or more.
NEUTRAL, STEEP, HALF_SAY = 0.4, 5.0, 4
GOOD_ROLE, BAD_ROLE, OUTSIDE, NEVER = 1.5, -1.5, -1.0, -4.0
BROADCAST_NODES = 1_000_000

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S)
_CLASS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"), "td": ("td th", "tr"), "th": ("td th", "tr"), "option": ("option", "select")}
_SIBLINGS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _SIBLINGS.items()}
_GOOD = frozenset(["article", "main"])
_BAD = frozenset("nav footer aside form".split())
_NEVER = frozenset("button select dialog menu svg canvas audio video object head".split())
_BAD_NAMES = frozenset("ad ads advert adverts advertisement adsense banner breadcrumb breadcrumbs cookie cookies consent footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets contentinfo complementary search".split())
_NEVER_NAMES = frozenset("comment comments commentlist disqus respond".split())
_PARTS = re.compile(r"[^a-z0-9]+")
#: Roles: declared good, nothing declared, declared bad, never main text.
GOOD, NONE, BAD, NOT_TEXT = 1, 0, -1, -2


def _role(tag: str, names: str, outer: int) -> int:
    """The role of an element within one of role outer."""
    parts = set(_PARTS.split(names)) if names else set()
    if outer == NOT_TEXT or tag in _NEVER or (parts & _NEVER_NAMES and tag not in ("html", "body")):
        return NOT_TEXT
    if tag in _GOOD or "main" in names.split():  # an article in a wrapper with a misleading name is an article
        return GOOD
    if outer == BAD:
        return BAD
    # a page's header is none of the article; an article's own header is
    if tag in _BAD or (tag == "header" and outer == NONE) or (parts & _BAD_NAMES and tag not in ("html", "body")):
        return BAD
    return outer


def blocks(page: str, shapes: dict[str, list[str]] | None = None) -> list[tuple[str, int, str]]:
    """The text blocks of a page in order: (path, role, text). Where shapes is given, it takes for each path the elements that each of its occurrences holds."""
    out: list[tuple[str, int, str]] = []
    stack: list[tuple[str, str, int, list[str]]] = [("", "", NONE, [])]  # element, path, role, elements it holds
    text: list[str] = []

    def flush() -> None:
        if text:
            t = " ".join(html.unescape("".join(text)).split())
            if t:
                out.append((stack[-1][1], stack[-1][2], t))
            text.clear()

    def pop(to: int) -> None:
        flush()
        if shapes is not None:
            for _, path, _, held in stack[to:]:
                shapes.setdefault(path, []).append(" ".join(held))
        del stack[to:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in _INLINE:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    pop(k)
                    break
            continue
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in _INLINE:
            stack[-1][3].append(tag)
            continue
        if tag in _ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    pop(k)
                    break
        elif tag in _SIBLINGS:
            ends, upto = _SIBLINGS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in upto:
                    break
                if stack[k][0] in ends:
                    pop(k)
        flush()
        stack[-1][3].append(tag)
        if tag in _VOID:
            continue
        _, path, role, _ = stack[-1]
        names = " ".join((a or b or c).lower() for _, a, b, c in _CLASS.findall(m[3])).replace(">", " ") if m[3] else ""
        stack.append((tag, f"{path}>{tag}.{names}" if names else f"{path}>{tag}", _role(tag, names, role), []))
    pop(1)
    return out


def _key(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s) - (1 << 63)


_NODES = "host string, path long, kind int, value long"
CONTENT, SHAPE = 0, 1


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page and node: each of its texts once, and the node's shape (the elements in all its occurrences) once."""
    for batch in batches:
        rows: list[tuple] = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shapes: dict[str, list[str]] = {}
            texts = {(path, text) for path, _, text in blocks(page or "", shapes)}
            rows.extend((host, _key(path), CONTENT, _key(text)) for path, text in texts)
            rows.extend((host, _key(path), SHAPE, _key("|".join(held))) for path, held in shapes.items())
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.int64()), strict=True)], names=["host", "path", "kind", "value"])


def style_tree(pages: DataFrame, page: str = "html", host: str = "host") -> DataFrame:
    """(host, path, pages, content, shape) of the nodes on two pages or more (on one the tree has no say): importance by content (null without text) and by shape.

    A value on n of a node's m pages has entropy log n / log m. Equal values are counted before the shuffle, so a hot host costs a row for each distinct node and value.
    """
    rows = pages.select(F.col(host), F.col(page).cast("string")).mapInArrow(_nodes, _NODES)
    counted = rows.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy("host", "path", "kind").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log("n")).alias("same"))
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    node = sums.groupBy("host", "path").agg(of(SHAPE, "n").alias("pages"), of(SHAPE, "same").alias("alike"), of(CONTENT, "n").alias("texts"), of(CONTENT, "same").alias("same"))
    size = F.log("pages")
    return node.filter("pages > 1").select("host", "path", "pages", (1 - F.col("same") / F.col("texts") / size).alias("content"), (1 - F.col("alike") / F.col("pages") / size).alias("shape"))


def told_apart(tree: DataFrame) -> DataFrame:
    """The style tree by what tells a host's pages apart. If every page stands there ten times, or all are one, nodes differ less than their number of pages allows;
    a host's most diverse node says how many pages there really are (the exponential of its entropy): no node counts more, and entropies are held against that."""
    of = F.coalesce(F.col("content"), F.lit(0.0)) * F.log("pages")
    most = tree.groupBy(F.col("host").alias("of")).agg(F.max(of).alias("most"))
    room = F.least(F.log("pages"), F.col("most"))
    share = lambda c: F.when(F.col(c).isNotNull(), F.when(room > 1e-9, F.least(F.lit(1.0), F.col(c) * F.log("pages") / room)).otherwise(1.0)).alias(c)
    return tree.join(most, F.col("host").eqNullSafe(F.col("of"))).select("host", "path", F.least(F.col("pages").cast("double"), F.exp("most")).alias("pages"), share("content"), share("shape"))


def _inner(path: str) -> list[str]:
    """The path and those of the elements around it, without body and html."""
    steps = path.split(">")
    return [">".join(steps[:k]) for k in range(len(steps), 0, -1) if steps[k - 1].split(".")[0] not in ("", "html", "body")]


def importance_of(path: str, tree: dict[int, tuple[float, float | None, float]]) -> tuple[float, float]:
    """(importance, the tree's say from 0 to 1): the block's content, halved where no element around it differs in shape between pages."""
    pages, content, _ = tree.get(_key(path)) or (1, None, 0.0)
    shape = max((tree[k][2] for k in map(_key, _inner(path)) if k in tree), default=0.0)
    return (content or 0.0) * (1 + shape) / 2, (pages - 1) / (pages - 1 + HALF_SAY)


def main_text(page: str, tree: dict[int, tuple[float, float | None, float]]) -> str:
    """The blocks that importance and prior together speak for. tree: path's key -> (pages, content, shape)."""
    found = blocks(page)
    inside = any(role == GOOD for _, role, _ in found)
    prior = {GOOD: GOOD_ROLE, BAD: BAD_ROLE, NOT_TEXT: NEVER, NONE: OUTSIDE if inside else 0.0}
    out, known = [], {}
    for path, role, text in found:
        if path not in known:
            importance, say = importance_of(path, tree)
            known[path] = say * STEEP * (importance - NEUTRAL) + prior[role] >= 0
        if known[path]:
            out.append(text)
    return " ".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, tree in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            texts.append(main_text(page or "", {x["path"]: (x["pages"], x["content"], x["shape"]) for x in tree or ()}))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "main"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, page: str = "html", url: str = "url", broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """(row, main): each row's other columns as one struct, and its main text."""
    keep = [c for c in pages.columns if c != page]
    hosted = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(page).cast("string").alias("html"), host_of(F.col(url)).alias("host"))
    tree = stash(told_apart(stash(style_tree(hosted), "nodes")), "tree")
    by_host = tree.groupBy(F.col("host").alias("of")).agg(F.collect_list(F.struct("path", "pages", "content", "shape")).alias("tree"))
    if tree.count() <= broadcast_nodes:
        by_host = F.broadcast(by_host)
    joined = hosted.join(by_host, F.col("host").eqNullSafe(F.col("of")), "left").select("row", "html", "tree")
    return joined.mapInArrow(_extract, StructType([hosted.schema["row"], StructField("main", StringType())]))


def op6_html_extract(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("row.page_id", "row.url", F.col("main").alias("text"), F.length("main").cast("long").alias("n_chars"))
