"""Blocks, chunks, table rules, sentence cuts and admission against plain Python."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from docloom.functions import text as T


def test_pieces_give_the_text_back(spark):
    from docloom.operators.markdown import CLOSE, OPEN, chunks, pieces

    rng = random.Random(3)
    mark = f'{OPEN} id="T1"〉a\n\nb{"x" * 80}{CLOSE}'
    texts = ["", "\n\n", None, mark, "a" * 205, "end." + mark + "\nnext"]
    texts += ["".join(rng.choice(["word ", "One. ", 'Two!" ', "\n", "\n\n", "\n\n\n", "y" * 70, mark]) for _ in range(rng.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for row in df.select("t", pieces(F.col("t"), 60).alias("ps")).collect():
        if row.t is None:
            assert row.ps is None
            continue
        assert "".join(row.ps) == row.t
        for p in row.ps:
            assert len(p) <= 60 or (p.startswith(OPEN) and p.endswith(CLOSE))
        assert sum(p == mark for p in row.ps) == row.t.count(mark)
    got = {}
    for row in chunks(df, "id", "t", 60).orderBy("id", "chunk").collect():
        got.setdefault(row.id, []).append(row.body)
    assert 2 not in got and 0 not in got and 1 not in got
    for i, t in enumerate(texts):
        squeeze = lambda s: re.sub(r"\s", "", s)
        assert squeeze("".join(got.get(i, []))) == squeeze(t or "")
        assert all(len(b) <= 60 or mark in b for b in got.get(i, []))


def test_blocks_of_markdown(spark):
    from docloom.operators.markdown import blocks

    md = "# Head\nline one\nline two\n\n| a | b |\n|--|--|\n| 1 | 2 |\n- item\n2. next\n\n![alt](p.png)\n\n$$ x $$\n\n####### no"
    got = blocks(spark.createDataFrame([(1, md), (2, None), (3, " \n\n ")], "id long, md string"), "id", "md").orderBy("ord").collect()
    assert [(r.type, r.level, r.body) for r in got] == [
        ("text", 1, "Head"),
        ("text", None, "line one\nline two"),
        ("table", None, "| a | b |\n|--|--|\n| 1 | 2 |"),
        ("text", None, "- item"),
        ("text", None, "2. next"),
        ("image", None, "![alt](p.png)"),
        ("equation", None, "x"),
        ("text", None, "####### no"),
    ]
    assert got[5].img_path == "p.png"


def test_outermost_tables(spark):
    from docloom.operators.markdown import top_tables

    html = "a<table>1<TABLE >2</table>3</TABLE>b</table><table x>4</table><table>5"
    assert spark.createDataFrame([(html,)], "h string").select(top_tables(F.col("h"))).first()[0] == ["<table>1<TABLE >2</table>3</TABLE>", "<table x>4</table>"]


def plain_rules(body):
    cells = [re.sub("<[^>]+>", "", c).strip(" ") for c in re.findall(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>", body or "")]
    joined = " ".join(c for c in cells if c)
    ratio = len(zlib.compress(joined.encode(), 6)) / len(joined.encode()) if len(joined) >= 200 else 1.0
    out, many, words = [], [c for c in cells if len(c) >= 2], joined.split()
    if ratio < 0.16:
        out.append("R1")
    if len(many) >= 20:
        share = max(Counter(many).values()) / len(many)
        if share >= 0.6:
            out.append("R2")
        if share >= 0.35 and ratio < 0.36:
            out.append("R3")
        if len(words) >= 30 and len(set(words)) <= 0.45 * len(words):
            out.append("R4")
    return out


def test_table_rules(spark):
    from docloom.operators.repetition import table_rules

    rng = random.Random(5)
    bodies = [None, "", "<table></table>"]
    for _ in range(150):
        kinds = [f"<b>{rng.choice('abcdef') * rng.randrange(4)}</b> {rng.randrange(9 ** rng.randrange(1, 7))}" for _ in range(rng.randrange(1, 40))]
        n = rng.randrange(60)
        bodies.append("".join(f"<td>{rng.choice(kinds[: rng.randrange(1, 1 + len(kinds))])}</td>" for _ in range(n)))
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    got = {r.id: r.rules for r in table_rules(df, "body").collect()}
    want = {i: plain_rules(b) for i, b in enumerate(bodies)}
    assert {i: list(v or []) for i, v in got.items()} == want
    assert {r for v in want.values() for r in v} == {"R1", "R2", "R3", "R4"}


def ends(s):
    return [m.end() for m in re.finditer(r"(?:(?<![0-9])[.!?][)\"'”’」』]?[ \t]+|\n+)", s) if m.end() < len(s)]


def test_sentence_cuts(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["abc def. ", "18.9 ", "2025. ", 'Yes!" ', "line\n", "x" * 45, "no stop "]) for _ in range(rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for row in df.select("t", T.head_to_sentence(F.col("t"), 60).alias("head"), T.tail_from_sentence(F.col("t"), 50, 70).alias("tail")).collect():
        t, n = row.t, len(row.t)
        fit = [e for e in ends(t) if e <= 60]
        assert row.head == (t if n <= 60 else t[: fit[-1]].rstrip() if fit else ""), t
        if n <= 50:
            assert row.tail == t
            continue
        starts = [0] + ends(t)
        back, ahead = max(s for s in starts if s <= n - 50), [s for s in starts if s > n - 50]
        assert row.tail == t[back if n - back <= 120 else ahead[0] if ahead else n - 50 :], t


def test_admission_fold(spark):
    from docloom.operators.admission import admit

    rng = random.Random(9)
    buckets, limits = {"a": ["x"], "b": ["x", "y"], "c": ["y"]}, {"x": 9, "y": 7}
    for _ in range(6):
        cand = [(k, k // 3, rng.choice("abcd"), rng.choice(["w1", "w2", "w3", None])) for k in range(60)]
        running = [(rng.choice("abcd"), rng.choice(["w1", "w2", None])) for _ in range(rng.randrange(6))]
        used, tenants, want = Counter(b for k, _ in running for b in buckets.get(k, [])), Counter(w for _, w in running), []
        for i, _, kind, w in cand:
            bs = buckets.get(kind, [])
            if len(want) < 10 and bs and all(used[b] < limits[b] for b in bs) and (w is None or tenants[w] < 3):
                used.update(bs)
                tenants[w] += 1
                want.append(i)
        df = spark.createDataFrame(cand, "id long, created_at long, kind string, workspace string")
        run = spark.createDataFrame(running, "kind string, workspace string")
        assert [r.id for r in admit(df, run, buckets, limits, 3, 10).collect()] == want


def test_assessed_pages(spark):
    from docloom.operators.repetition import assessed_pages, order_tables
    from docloom.plans.registry import table

    sf = "/root/testdata/sf0.001"
    owner = {r.o_orderkey: r.o_custkey for r in table(spark, sf, "orders").collect()}
    want = {}
    for r in order_tables(spark, sf).collect():
        rules, n = plain_rules(r.body), len(re.sub(r"\s", "", re.sub("<[^>]+>", "", r.body)))
        kind = 0 if not rules else 2 if set(rules) <= {"R3", "R4"} else 1
        page = want.setdefault(owner[r.l_orderkey], [0, 0, 0, False])
        page[0] += n
        page[3] |= kind > 0
        if kind:
            page[kind] += n
    got = {r.o_custkey: [r.chars, r.chars_hard, r.chars_soft, r.degenerate] for r in assessed_pages(spark, sf).collect()}
    assert got == want and any(p[2] for p in want.values())
