import random
import re
import time

import pytest
from pyspark.sql import functions as F

from docloom.functions import table_html as t

CASES = {
    "<table class='x' onclick=\"a()\"><TR><td>1 < 2 & 3</td></TR></table>": "<table><tr><td>1 &lt; 2 &amp; 3</td></tr></table>",
    "<td>a<br>b<br/>c</br></td>": "<td>a<br/>b<br/>c<br/></td>",
    "<script>alert(1)</script><b>x</b>": "<b>x</b>",
    "<SCRIPT src=a>x</ script ><i>y</i>": "<i>y</i>",
    "<script>never closed <b>x</b>": "never closed <b>x</b>",
    "<style>a<script>b</style>c</script>d": "cd",
    "<script>a<style>b</style>c</script>d<style>e": "de",
    "<img src=x onerror=y>&lt;<a href='j'>z</a>": "&amp;lt;z",
    "<table><tr><td><table><tr><td>in</td></tr></table></td></tr></table>": "<table><tr><td><table><tr><td>in</td></tr></table></td></tr></table>",
    "<td unclosed": "&lt;td unclosed",
    "<<b>>": "&lt;<b>&gt;",
    "< b>space": "<b>space",
    "</ b >": "</b>",
    "<b_c>text</b_c>": "&lt;b_c&gt;text&lt;/b_c&gt;",
    "<!-- c --><?p?>": "&lt;!-- c --&gt;&lt;?p?&gt;",
    "a \"q\" 'r'": "a \"q\" 'r'",
    "": "",
    None: None,
}


def test_sanitized(spark):
    got = spark.createDataFrame([(k,) for k in CASES], "x string").select("x", t.sanitized(F.col("x")).alias("y")).collect()
    assert {r.x: r.y for r in got} == CASES


def test_segments(spark):
    cases = {
        "a<table>b</table>c": [("text", "a"), ("table", "<table>b</table>"), ("text", "c")],
        "<TABLE id=1>x</ table >": [("table", "<TABLE id=1>x</ table >")],
        "<table>a<table>b</table>c</table>d": [("table", "<table>a<table>b</table>"), ("text", "c</table>d")],
        "<table>open": [("text", "<table>open")],
        "<tablet>x</table>": [("text", "<tablet>x</table>")],
        "": [],
        None: None,
    }
    got = spark.createDataFrame([(k,) for k in cases], "x string").select("x", t.segments(F.col("x")).alias("y")).collect()
    assert {r.x: None if r.y is None else [tuple(p) for p in r.y] for r in got} == cases


def test_random_texts():
    """Against expressions over the whole text, and put together again."""
    rng = random.Random(3)
    parts = ["<", ">", "<table", "<b>", "</b>", "<script>", "</script>", "< style", "</ style >", "<table>", "</table>", "<td a='1'>", "x", "&", " ", "/", "<br", "é"]
    for _ in range(3000):
        s = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        spans = [m.span() for m in re.finditer(r"<\s*(script|style)\b[\s\S]*?<\s*/\s*\1\s*>", s, re.IGNORECASE)]
        assert list(t.elements(s, t.DROPPED)) == spans
        assert [(a, b) for a, b, _, _ in t.tags(s)] == [m.span() for m in re.finditer(r"</?\s*([a-zA-Z][a-zA-Z0-9]*)\b[^>]*>", s)]
        assert "".join(p["text"] for p in t._parts(s)) == s
        assert set(re.findall(r"<[^>]*>?", t._shown(s))) <= {f"<{c}{n}>" for n in t.KEPT_TAGS for c in ("", "/")} | {"<br/>"}


@pytest.mark.parametrize("part", ["<script>", "<a ", "<table>", "< ", "<style><script>", "<"])
def test_hostile_texts_take_linear_time(part):
    started = time.time()
    t._shown(part * 200_000)
    t._parts(part * 200_000)
    assert time.time() - started < 20


def test_python_holds_a_slice_of_a_batch():
    """Texts become Python objects SLICE at a time, whatever the size of a batch."""
    import weakref

    import pyarrow as pa

    from docloom.functions import table_html as t

    alive, most = weakref.WeakSet(), 0

    class Part(dict):
        __hash__ = object.__hash__

    def of(text):
        nonlocal most
        part = Part(kind="text", text=text)
        alive.add(part)
        most = max(most, len(alive))
        return [part]

    texts = [str(k) if k % 7 else None for k in range(1000)]
    got = t._by_slices(pa.array(texts), of, t._PARTS)
    assert got.to_pylist() == [None if x is None else [{"kind": "text", "text": x}] for x in texts] and most <= 2 * t.SLICE
    assert t._by_slices(pa.array([], pa.string()), of, t._PARTS).to_pylist() == []
