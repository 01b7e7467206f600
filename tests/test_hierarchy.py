import random
import re

from pyspark.sql import functions as F

from docloom.operators.hierarchy import MARKERS, marker_kind, paths

TEXTS = ["Sales", "Staff", "1. one", "2) two", "가. first", "나) second", "(1) part", "(가) part", "(b) part", "IV. four", "iv) four", "B. big", "b) small", "- dot", "제 3 조", "1-2. both", "1.1 deep", "3.5", "  ", None, "○ none"]


def plain(cells, cols):
    """A stack for each column, cell by cell."""
    def kind(t):
        return next((k for k, p in MARKERS if re.match(p, t)), None)

    stacks, out = {c: [] for c in cols}, {}
    for (r, c), t in sorted(cells.items()):
        if c not in cols or not (t or "").strip():
            continue
        t = t.strip()
        k = kind(t)
        if k is None:
            stacks[c] = [(None, t)]
        else:
            while any(s == k for s, _ in stacks[c]):
                stacks[c].pop()
            stacks[c].append((k, t))
        for d in cols:
            if d > c:
                stacks[d] = []
        out[r] = [x for d in sorted(cols) for _, x in stacks[d]]
    return out


def test_kinds_of_markers(spark):
    got = {r.t: r.k for r in spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", marker_kind(F.col("t")).alias("k")).collect()}
    assert got["1. one"] == "num" and got["가. first"] == "kor" and got["(가) part"] == "pkor" and got["IV. four"] == "uroman" and got["1-2. both"] == "dec"
    assert got["3.5"] is got["Sales"] is got[None] is got["○ none"] is None and got["제 3 조"] == "je" and got["- dot"] == "bullet" and got["b) small"] == "alpha"


def test_random_sheets_against_plain_python(spark):
    rng = random.Random(8)
    made = {s: {(r, c): rng.choice(TEXTS) for r in range(rng.choice([1, 10, 40])) for c in range(4) if rng.random() < 0.6} for s in [None, *range(12)]}
    rows = [(s, r, c, t) for s, cells in made.items() for (r, c), t in cells.items()]
    rows += rows[:5]
    got = {}
    for r in paths(spark.createDataFrame(rows, "sheet int, row long, col int, text string").repartition(4), (2, 0, 1)).collect():
        got.setdefault(r.sheet, {}).setdefault(r.row, []).append(list(r.path))
    assert got == {s: {r: [p] for r, p in plain(cells, (0, 1, 2)).items()} for s, cells in made.items() if plain(cells, (0, 1, 2))}


def test_a_shallow_change_empties_deeper_columns(spark):
    cells = [(1, 0, 0, "Sales"), (1, 0, 1, "1. plan"), (1, 1, 1, "a) goal"), (1, 2, 1, "b) cost"), (1, 3, 1, "2. act"), (1, 4, 2, "note"), (1, 5, 0, "Staff"), (1, 6, 1, "a) hire")]
    got = {r.row: list(r.path) for r in paths(spark.createDataFrame(cells, "sheet int, row long, col int, text string"), (0, 1, 2)).collect()}
    assert got == {0: ["Sales", "1. plan"], 1: ["Sales", "1. plan", "a) goal"], 2: ["Sales", "1. plan", "b) cost"], 3: ["Sales", "2. act"], 4: ["Sales", "2. act", "note"], 5: ["Staff"], 6: ["Staff", "a) hire"]}
    assert paths(spark.createDataFrame([], "sheet int, row long, col int, text string"), (0,)).collect() == []


def test_sheets_stream_in_batches_of_any_size(spark):
    import pyarrow as pa

    from docloom.operators import hierarchy as H

    cells = [(s, r, c, t, k) for s in (None, 1, 2) for r, c, t, k in [(0, 0, "a", None), (0, 1, "1. x", "num"), (1, 1, "a) y", "alpha"), (1, 1, "b) y", "alpha"), (2, 1, "2. z", "num"), (3, 0, "b", None)]]
    names = ("sheet", "row", "col", "text", "kind")
    batch = pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in cells])
    want = [(s, r, p) for s in (None, 1, 2) for r, p in enumerate([["a", "1. x"], ["a", "1. x", "a) y"], ["a", "2. z"], ["b"]])]
    for step in (1, 4, 100):
        got = [tuple(x.values()) for b in H._fold(batch.slice(i, step) for i in range(0, len(cells), step)) for x in b.to_pylist()]
        assert got == want
    c = spark.createDataFrame([(1, 1, 0, "a")], "sheet int, row int, col int, text string")
    plan = H.paths(c, (0, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan and "FlatMapGroups" not in plan
