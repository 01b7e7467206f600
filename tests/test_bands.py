import random
import re

import pytest

from docloom.operators import bands as b

CELL = "sheet int, row long, col long, text string, number double, dated boolean, bold boolean, center boolean, shaded boolean, bordered boolean, wide boolean"
REGION = "sheet int, region int, r0 long, r1 long, c0 long, c1 long, title_r0 long, title_r1 long, filter_row long"
MERGE = "sheet int, r0 long, r1 long, c0 long, c1 long"
MARKS = {"○", "X", "●"}


def one_line(t):
    return re.sub(r"\s+", " ", t or "").strip(" ")


def numbered(t):
    return bool(re.match(r"[a-z]\)|\([0-9]+\)|[0-9]+\.( |$)|[0-9]+\.[0-9]+( |$)|[0-9]+\.[0-9]+\.[0-9]+( |$)", t))


class Sheet:
    """Rows one after the other."""

    def __init__(self, cells, region, merges):
        self.r0, self.r1, self.c0, self.c1, self.t0, self.t1, self.filter = region
        self.cells = {(r, c): (one_line(t), *x) for (r, c), (t, *x) in cells.items() if one_line(t) and self.r0 <= r <= self.r1 and self.c0 <= c <= self.c1}
        self.merges = merges
        self.n = self.c1 - self.c0 + 1

    def row(self, r):
        return [self.cells[r, c] for c in range(self.c0, self.c1 + 1) if (r, c) in self.cells]

    def title(self, r):
        return self.t0 is not None and self.t0 <= r <= self.t1

    def values(self, x):
        t = re.sub(r"\s", "", x[0])
        return x[1] is not None or bool(x[2]) or bool(re.match(r"-?[\d,]+(\.\d+)?%?$", t)) or bool(re.match(r"\d{4}[.\-/]\d{1,2}[.\-/]\d{1,2}\.?$", t))

    def pair(self, r):
        x = self.row(r)
        return any(re.match(r".+[:：]\s*$", y[0]) for y in x) and len(x) / self.n < 0.5

    def item(self, r):
        return any(y[0] in MARKS or numbered(y[0]) for y in self.row(r))

    def data(self, r):
        return sum(map(self.values, self.row(r))) / len(self.row(r)) >= 0.5

    def score(self, r):
        x = self.row(r)
        f = len(x)
        share = lambda k: sum(bool(y[k]) for y in x) / f
        v = sum(map(self.values, x)) / f
        s = 1.2 * share(3) + 0.8 * share(4) + 0.6 * share(5) + 0.4 * share(6) + 0.8 * (1 - v) + 0.5 * sum(len(y[0]) <= 14 for y in x) / f + 0.4 * share(7) + 0.6 * f / self.n
        s -= 1.5 * sum(y[0] in MARKS for y in x) / f + 1.5 * sum(numbered(y[0]) for y in x) / f + 0.8 * v
        style = share(3) + share(5) + (0.5 if share(4) >= 0.5 else 0)
        if r == self.filter and v < 0.5 and not self.pair(r):
            s, style = s + 0.8, style + 0.5
        return round(s, 9), round(style, 9)

    def axis(self, r):
        x = [y[1] for y in self.row(r) if y[1] is not None]
        return len(x) >= 3 and 2 * len(x) > len(self.row(r)) and all(round(q - p, 6) == 1 for p, q in zip(x, x[1:], strict=False))

    def scan(self, r, depth):
        top, head, before = r, [], 0
        for r in range(top, self.r1 + 1):
            if self.title(r) or not self.row(r):
                if head:
                    break
                before += 1
                continue
            if not head and self.pair(r):
                before += 1
                continue
            if self.item(r):
                break
            s, style = self.score(r)
            if head and self.data(r):
                return head + [(r, None)] if self.axis(r) else head
            if s >= 1.8 and style >= 0.5 and len(self.row(r)) >= 2:
                head.append((r, s))
                if len(head) >= depth:
                    break
            elif head and s >= 1.8 and len(self.row(r)) >= 2 and any(m0 in dict(head) and m0 < r <= m1 for m0, m1, *_ in self.merges):
                return head + [(r, s)]
            elif head:
                break
            else:
                before += 1
                if before >= 8:
                    break
        return head

    def bands(self, depth=5):
        head = self.scan(self.r0, depth)
        if self.filter is not None and self.r0 <= self.filter <= self.r1 and (not head or self.filter > head[-1][0]):
            head = self.scan(self.filter, depth) or head
        return head

    def footers(self, head):
        body = [r for r in range(self.r0, self.r1 + 1) if self.row(r) and not self.title(r) and (not head or r > head[-1][0])]

        def kind(r):
            x = [y[0] for y in self.row(r)]
            texts = [t for t in x if t not in MARKS]
            if any(t.lower() in ("total", "합계", "소계", "계") for t in texts):
                return "total"
            return "note" if texts and len(texts) == len(x) and re.match(r"※|주\)|비고|참고|단,", texts[0]) else "body"

        block = []
        for r in reversed(body):
            if kind(r) == "body" or len(block) == 15:
                break
            block.insert(0, r)
        if not block or len(block) >= len(body):
            return []
        up = block[0] - 1
        if not (all(kind(r) == "total" for r in block) or (up >= self.r0 and not self.row(up))):
            while any(kind(r) == "total" for r in block):
                block.pop(0)
        return [(r, kind(r)) for r in block]


TEXTS = ["Name", "State", "구분", "비고", "a very long label indeed", "2024", "12.5%", "2024-05-01", "○", "X", "1. one", "a) two", "Author:", "합계", "total", "※ note", "단, this", " ", None, "Sum\n due"]


def sheets(rng, n):
    for s in [None, *range(n)]:
        rows, cols = rng.choice([1, 4, 12, 40]), rng.choice([2, 3, 5, 8])
        head, cells = rng.randint(0, 9), {}
        for r in range(1, rows + 1):
            how = rng.random()
            for c in range(1, cols + 1):
                if rng.random() < (0.15 if how < 0.15 else 0.9):
                    near = head <= r <= head + 3
                    t = rng.choice(TEXTS[:4] if near and how > 0.2 else TEXTS if r > head or how < 0.05 else [*TEXTS[3:8], "Author:", " ", None])
                    number = float(r + c) if how > 0.8 and near else rng.choice([None] * 9 + [7.0])
                    cells[r, c] = (t if number is None else str(number), number, rng.random() < 0.05, *(near and rng.random() < 0.8 for _ in range(5)))
        if rng.random() < 0.5:
            for r in range(max(1, rows - rng.randint(0, 17)), rows + 1):
                cells = {k: v for k, v in cells.items() if k[0] != r}
                if rng.random() < 0.9:
                    cells[r, 1] = (rng.choice(["합계", "※ a", "※ b", "단, c"]), None, *[False] * 6)
        merges = [(r, r + rng.randint(0, 2), c, min(cols, c + rng.randint(0, 2))) for r in range(1, rows + 1) for c in [rng.randint(1, cols)] if rng.random() < 0.4]
        t0 = rng.choice([None, None, 1, 3])
        yield s, cells, (1, rows, 1, cols, t0, t0, rng.choice([None, None, rng.randint(1, rows + 2)])), merges


@pytest.fixture(scope="module")
def made():
    return list(sheets(random.Random(11), 400))


@pytest.fixture(scope="module")
def frames(spark, made):
    cells = [(s, r, c, *x) for s, cs, _, _ in made for (r, c), x in cs.items()]
    regions = spark.createDataFrame([(s, 7, *g) for s, _, g, _ in made], REGION)
    c = b.placed(spark.createDataFrame(cells + cells[:9], CELL).repartition(5), regions).persist()
    return c, regions, spark.createDataFrame([(s, *m) for s, _, _, ms in made for m in ms], MERGE)


def by_sheet(rows, *cols):
    out = {}
    for r in rows:
        out.setdefault(r.sheet, []).append(tuple(r[c] for c in cols))
    return {s: sorted(x) for s, x in out.items()}


@pytest.mark.parametrize("depth", [1, 5])
def test_bands_against_a_scan(frames, made, depth):
    c, regions, merges = frames
    got = by_sheet(b.bands(c, regions, merges, depth).collect(), "row", "score")
    want = {s: h for s, cs, g, m in made if (h := Sheet(cs, g, m).bands(depth))}
    assert len(want) > 40
    assert {s: [r for r, _ in x] for s, x in got.items()} == {s: [r for r, _ in x] for s, x in want.items()}
    for s, x in want.items():
        assert [y for _, y in got[s]] == [None if y is None else pytest.approx(y, abs=1e-8) for _, y in x]


def test_footers_against_a_scan(frames, made):
    c, regions, merges = frames
    got = by_sheet(b.footers(c, regions, b.bands(c, regions, merges)).collect(), "row", "kind")
    want = {s: f for s, cs, g, m in made if (f := Sheet(cs, g, m).footers(Sheet(cs, g, m).bands()))}
    assert len(want) > 20 and got == want


def test_years_and_merges_continue_a_band(spark):
    """Sheets 1: years; 2: amounts; 3: a plain row under a merge of the band; 4: the same without a merge."""
    label, plain = (None, False, True, True, False, False, False), (None, False, *[False] * 5)
    cells = [(s, 1, c, f"L{c}", *label) for s in (1, 2, 3, 4) for c in range(1, 5)]
    cells += [(s, 2, 1, "Task", *plain) for s in (1, 2)] + [(s, 2, c, str(v), float(v), False, *[False] * 5) for s, vs in ((1, (2024, 2025, 2026)), (2, (100, 200, 300))) for c, v in enumerate(vs, 2)]
    cells += [(s, r, c, f"v{r}{c}", *plain) for s in (3, 4) for r in (2, 3) for c in range(1, 5)]
    regions, merges = [(s, (1, 3, 1, 4, None, None, None)) for s in (1, 2, 3, 4)], [(3, 1, 2, 1, 1)]
    c = b.placed(spark.createDataFrame(cells, CELL), r := spark.createDataFrame([(s, 0, *g) for s, g in regions], REGION))
    got = by_sheet(b.bands(c, r, spark.createDataFrame(merges, MERGE)).collect(), "row", "score")
    assert {s: [x for x, _ in h] for s, h in got.items()} == {1: [1, 2], 2: [1], 3: [1, 2], 4: [1]} and got[1][1][1] is None
    for s, g in regions:
        assert [x for x, _ in Sheet({(x[1], x[2]): x[3:] for x in cells if x[0] == s}, g, [m[1:] for m in merges if m[0] == s]).bands()] == [x for x, _ in got[s]]


def test_names_and_roles(spark):
    style = (None, False, True, True, False, False, False)
    head = {1: ["업무", "업무", "Q", "Q", None, "비 고"], 2: ["업무", "종류", "in", "in", None, "비 고"]}
    cells = [(1, r, c + 1, t, *style) for r, ts in head.items() for c, t in enumerate(ts) if t]
    cells += [(1, r, c, f"v{r}{c}", None, False, *[False] * 5) for r in range(3, 9) for c in range(1, 7)]
    # two: labels in the second column on, items told by their numbers
    cells += [(2, 1, c, t, *style) for c, t in ((2, "What"), (3, "State"))]
    cells += [(2, r, 2, f"{r}. item", None, False, *[False] * 5) for r in range(2, 6)] + [(2, r, 3, "○", None, False, *[False] * 5) for r in range(2, 6)]
    regions = spark.createDataFrame([(1, 0, 1, 8, 1, 6, None, None, None), (2, 0, 1, 5, 1, 3, None, None, None), (3, 0, 1, 5, 1, 3, None, None, None)], REGION)
    merges = spark.createDataFrame([(1, 1, 1, 1, 2)], MERGE)
    c = b.placed(spark.createDataFrame(cells, CELL), regions)
    h = b.bands(c, regions, merges)
    assert by_sheet(h.collect(), "row") == {1: [(1,), (2,)], 2: [(1,)]}
    got = {(r.sheet, r.col): (r.name, r.role) for r in b.roles(c, b.names(c, regions, h), h, merges).collect()}
    assert [got[1, k] for k in range(1, 7)] == [("업무", "items"), ("업무_종류", "items"), ("Q_in", "values"), ("Q_in_2", "values"), ("Q_in_3", "values"), ("비 고", "remarks")]
    assert [got[2, k] for k in range(1, 4)] == [(None, None), ("What", "items"), ("State", "values")] and len(got) == 9


def test_empty(spark):
    c, r, m = (spark.createDataFrame([], x) for x in (CELL, REGION, MERGE))
    p = b.placed(c, r)
    h = b.bands(p, r, m)
    assert h.collect() == [] == b.footers(p, r, h).collect() == b.roles(p, b.names(p, r, h), h, m).collect()


def test_nothing_that_grows_with_the_sheets_is_broadcast(spark):
    from docloom.plans.registry import QUERIES

    for name in ("m10_header_bands", "m11_column_roles", "m12_footers"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan
