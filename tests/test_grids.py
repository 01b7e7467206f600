import random
import re

from docloom.operators import grids as g

CELL = "sheet int, row long, k long, text string, cs long, rs long"


def fill(rows):
    """Every covered place marked one by one; rows: {row: [(text, cs, rs)]}. Returns (anchors, grid)."""
    found, grid, last = {}, {}, max(rows)
    for r in sorted(rows):
        col = 1
        for text, cs, rs in rows[r]:
            cs, rs = max(cs or 1, 1), max(rs or 1, 1)
            while (r, col) in grid:
                col += 1
            for y in range(r, min(last, r + rs - 1) + 1):
                for x in range(col, col + cs):
                    grid[y, x] = (text or "", r, col)
            found[r, col] = (text or "", cs, min(rs, last - r + 1))
            col += cs
    return found, grid


def frame(spark, sheets):
    rows = [(s, r, k, *x) for s, t in sheets.items() for r, cells in t.items() for k, x in enumerate(cells)]
    return spark.createDataFrame(rows + rows[:7] + [(1, None, 0, "x", 1, 1), (1, 0, None, "x", 1, 1)], CELL).repartition(4)


def test_random_tables_against_marking(spark):
    rng = random.Random(5)
    span = lambda: rng.choice([1, 1, 1, 1, 2, 3, 7, 0, None])
    sheets = {s: {r: [(rng.choice(["a", "b", "", None]), span(), span()) for _ in range(rng.randint(1, 6))] for r in range(rng.choice([1, 3, 30])) if r == 0 or rng.random() < 0.95} for s in [None, *range(60)]}
    a = g.anchors(frame(spark, sheets)).persist()
    got, grid = {s: {} for s in sheets}, {s: {} for s in sheets}
    for r in a.collect():
        assert (r.row, r.col) not in got[r.sheet]
        got[r.sheet][r.row, r.col] = (r.text, r.cs, r.rs)
    for r in g.expanded(a).collect():
        grid[r.sheet][r.row, r.col] = (r.text, r.top, r.left)
    for s, t in sheets.items():
        found, full = fill(t)
        assert got[s] == found and grid[s] == full


def test_pieces_do_not_matter(spark, monkeypatch):
    sheets = {1: {r: [("x", 1, 1 + r % 3), ("y", 1 + r % 2, 1)] for r in range(50)}}
    monkeypatch.setattr(g, "PIECES", 1)
    assert {(r.row, r.col): (r.text, r.cs, r.rs) for r in g.anchors(frame(spark, sheets)).collect()} == fill(sheets[1])[0]


def test_very_wide_spans_stay_ranges():
    assert g.free_columns([(0, 10**9, 10**9), (0, 1, 1), (1, 1, 1)]) == [1, 10**9 + 1, 10**9 + 1]


def plain_labels(upper, lower):
    """upper, lower: [(col, label, cs)] without empty ones."""
    spans, prev = [], None
    for c, t, cs in upper:
        if prev and t == prev[2] and c == prev[1] + 1 and len(t) >= 2 and re.search(r"[^\W\d_]", t) and t not in ("해당",):
            prev = (prev[0], c + cs - 1, t, True)
            continue
        spans += [prev] if prev else []
        prev = (c, c + cs - 1, t, cs >= 2)
    spans = [x for x in [*spans, prev] if x[1] > x[0] and x[3]]
    if not spans or not lower or len(lower) <= len(spans) or any(t in ("○", "X") for _, t, _ in lower) or sum(cs == 1 for *_, cs in lower) / len(lower) < 0.7:
        return {}
    if not any(lo <= c <= hi for c, *_ in lower for lo, hi, *_ in spans):
        return {}
    over = {x: t for c, t, cs in upper for x in range(c, c + cs)}
    leaf = over | {c: t for c, t, _ in lower}
    return {c: (t, over[c] if c in over and over[c] != t else None) for c, t in leaf.items()}


def test_two_row_headers_against_plain_python(spark):
    rng = random.Random(9)
    sheets = {}
    for s in range(150):
        up = [(rng.choice(["Team", "Team", "Pa\nrt", "-", "12", "", "해당"]), rng.choice([1, 1, 2, 3]), rng.choice([1, 1, 1, 2])) for _ in range(rng.randint(1, 4))]
        low = [(rng.choice(["in", "out", "sum", "Team", "", "○" if s % 5 == 0 else "x1"]), rng.choice([1] * 7 + [2]), 1) for _ in range(rng.randint(1, 7))]
        sheets[s] = {0: up, 1: [("", 1, 1)], 2: low, 3: [("v", 1, 1)]} if s % 4 == 0 else {0: up, 1: low}
    a = g.anchors(frame(spark, sheets)).persist()
    rows = spark.createDataFrame([(s, 0) for s in sheets], "sheet int, row long")
    got = {}
    for r in g.two_row_headers(a, rows).collect():
        got.setdefault(r.sheet, {})[r.col] = (r.leaf, r.over)
    want = {}
    for s, t in sheets.items():
        found = fill(t)[0]
        text = lambda x: x.replace("\n", "").strip()
        of = lambda row: [(c, text(x[0]), x[1]) for (r, c), x in sorted(found.items()) if r == row and text(x[0])]  # noqa: B023, E731
        full = [r for r in sorted(t) if of(r)]
        if full and full[0] == 0 and len(full) > 1 and (x := plain_labels(of(0), of(full[1]))):
            want[s] = x
    assert len(want) > 30 and got == want


def test_empty(spark):
    a = g.anchors(spark.createDataFrame([], CELL))
    assert a.collect() == g.expanded(a).collect() == g.two_row_headers(a, a.select("sheet", "row")).collect() == []


def test_many_sheets_share_a_batch_and_a_sheet_spans_batches(spark):
    """Sheets are no groups of their own: one call of Python fills all that lie in a task, and a sheet goes on over batches."""
    import pyarrow as pa

    rows = [(s, r, k, "t", 1, 2 if k == 0 else 1) for s in (None, 1, 2) for r in range(6) for k in range(2) if not (k == 0 and r % 2)]
    rows.insert(3, rows[2])  # a repeated cell
    batch = pa.RecordBatch.from_pylist([dict(zip(("sheet", "row", "k", "text", "cs", "rs"), x, strict=True)) for x in rows])
    want = [c for s in (None, 1, 2) for c in g.free_columns([x[1:2] + x[4:] for n, x in enumerate(rows) if x[0] == s and n != 3])]
    for cuts in ([0, len(rows)], list(range(len(rows) + 1)), [0, 4, 5, len(rows)]):
        got = list(g._fill(batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:], strict=False)))
        assert [c for b in got for c in b.column("col").to_pylist()] == want
    plan = g.anchors(frame(spark, {1: {0: [("x", 1, 1)]}}))._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan
