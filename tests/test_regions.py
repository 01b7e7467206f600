import random

from docloom.operators import regions as R


def plain_boxes(cells, gap_r=1, gap_c=1):
    """{box: cells} by flooding from cell to cell."""
    left, out = set(cells), []
    while left:
        todo, group = [left.pop()], []
        while todo:
            r, c = todo.pop()
            group.append((r, c))
            near = {(x, y) for x, y in left if abs(x - r) <= gap_r + 1 and abs(y - c) <= gap_c + 1}
            left -= near
            todo += near
        rows, cols = zip(*group, strict=True)
        out.append([min(rows), max(rows), min(cols), max(cols)])
    return out


def first_pair(boxes, test):
    return next(((i, j) for i in range(len(boxes)) for j in range(i + 1, len(boxes)) if test(boxes[i], boxes[j])), None)


def around(a, b):
    return [min(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3])]


def meets(a, b):
    return a[0] <= b[1] and b[0] <= a[1] and a[2] <= b[3] and b[2] <= a[3]


def titled(a, b):
    a, b = sorted((a, b), key=lambda x: x[0])
    shared = min(a[3], b[3]) - max(a[2], b[2]) + 1
    narrow = min(a[3] - a[2], b[3] - b[2]) + 1
    return 0 <= b[0] - a[1] - 1 <= 2 and shared >= 0.6 * narrow and (a[1] - a[0] <= 1 or b[1] - b[0] <= 1)


def plain_regions(cells):
    """cells {(r, c): bordered}."""
    boxes = plain_boxes(cells)
    for test in (meets, titled, meets):
        boxes.sort(key=lambda b: (b[0], b[2]))
        while pair := first_pair(boxes, test):
            i, j = pair
            boxes[i] = around(boxes[i], boxes.pop(j))
            boxes.sort(key=lambda b: (b[0], b[2]))
    full = []
    for b in boxes:
        own = [x for (r, c), x in cells.items() if b[0] <= r <= b[1] and b[2] <= c <= b[3]]
        full.append((*b, len(own), sum(own), len(own) / ((b[1] - b[0] + 1) * (b[3] - b[2] + 1))))
    main = max(full, key=lambda b: (b[4], -b[0], -b[2]))
    if main[5] / main[4] < 0.3 or main[4] < 20:
        return full
    keep = []
    for b in full:
        below = b[0] > main[1] + 2
        beside = not (b[1] < main[0] or b[0] > main[1]) and (b[2] > main[3] + 2 or b[3] < main[2] - 2)
        if b == main or not (below or beside) or (b[4] >= 12 and b[6] >= 0.35 and b[3] > b[2]):
            keep.append(b)
    return keep


def sheets(seed, many):
    rng = random.Random(seed)
    out = {}
    for s in range(many):
        cells = {(rng.randrange(40), rng.randrange(30)): rng.random() < 0.5 for _ in range(rng.choice([1, 15, 60, 120]))}
        if s % 3 == 0:
            r0, c0 = rng.randrange(30), rng.randrange(20)
            cells |= {(r, c): rng.random() < 0.8 for r in range(r0, r0 + 8) for c in range(c0, c0 + 5)}
        out[s] = cells
    return out


def frame(spark, made):
    rows = [(s, r, c, b) for s, cells in made.items() for (r, c), b in cells.items()]
    return spark.createDataFrame(rows, "sheet int, row long, col long, bordered boolean")


def test_components_against_flooding(spark):
    for seed, gaps in ((1, (1, 1)), (2, (0, 2))):
        made = sheets(seed, 12)
        got = {}
        for r in R.components(frame(spark, made), *gaps).collect():
            got.setdefault(r.sheet, []).append([r.r0, r.r1, r.c0, r.c1])
        assert {s: sorted(x) for s, x in got.items()} == {s: sorted(plain_boxes(c, *gaps)) for s, c in made.items()}


def test_regions_against_plain_python(spark):
    made = sheets(7, 18)
    got = {}
    for r in sorted(R.regions(frame(spark, made)).collect(), key=lambda r: (r.sheet, r.region)):
        got.setdefault(r.sheet, []).append((r.r0, r.r1, r.c0, r.c1, r.cells, r.bordered, round(r.density, 9)))
    assert got == {s: [(*b[:6], round(b[6], 9)) for b in sorted(plain_regions(c), key=lambda b: (b[0], b[2]))] for s, c in made.items()}
    assert any(len(plain_regions(c)) < len(plain_boxes(c)) for c in made.values())


def test_a_tall_column_a_comb_repeats_and_nulls(spark):
    cells = [(None, r, 3, True) for r in range(500)] + [(1, r, c, False) for r in range(0, 40) for c in range(0, 30, 5)] + [(1, 0, c, False) for c in range(30)]
    cells += [(1, 0, 0, True), (1, None, 4, True), (1, 4, None, True), (2, 5, 5, None)]
    got = {(r.sheet, r.r0, r.r1, r.c0, r.c1, r.cells, r.bordered) for r in R.components(spark.createDataFrame(cells, "sheet int, row long, col long, bordered boolean"), 0, 0).collect()}
    assert got == {(None, 0, 499, 3, 3, 500, 500), (1, 0, 39, 0, 29, 6 * 39 + 30, 1), (2, 5, 5, 5, 5, 1, 0)}


def test_boxes_within_boxes_and_chains(spark):
    ring = {(r, c): True for r in range(20) for c in range(20) if r in (0, 19) or c in (0, 19)}
    made = {0: ring | {(r, c): True for r in range(6, 14) for c in range(6, 14)}, 1: {(5 * k, c): True for k in range(6) for c in range(4)}}
    got = {(r.sheet, r.r0, r.r1, r.c0, r.c1) for r in R.regions(frame(spark, made)).collect()}
    assert got == {(s, *b[:4]) for s, c in made.items() for b in plain_regions(c)} and (0, 0, 19, 0, 19) in got


def test_empty(spark):
    assert R.regions(frame(spark, {})).collect() == []


def test_large_and_small_sheets_and_no_pairs_across_sheets(spark, monkeypatch):
    """Sheets above and below the bound give what plain Python gives, and boxes look for each other within their sheet only."""
    made = sheets(11, 9)
    want = {(s, *b[:4]) for s, c in made.items() for b in plain_regions(c)}
    for bound in (0, 12, 4096):
        monkeypatch.setattr(R, "LOCAL", bound)
        assert {(r.sheet, r.r0, r.r1, r.c0, r.c1) for r in R.regions(frame(spark, made)).collect()} == want
    links = []
    monkeypatch.setattr(R.graph, "connected", lambda x, near=(): links.append(x) or x.select(x.a.alias("v"), x.b.alias("c")).limit(0))
    monkeypatch.setattr(R, "kept", lambda df: links.append(df) or df)
    boxes = spark.createDataFrame([(s, s, 0, 1, 0, 1, 4, 0) for s in range(50)], "sheet long, id long, r0 long, r1 long, c0 long, c1 long, cells long, bordered long")
    R.clusters(boxes)
    keys = [x._jdf.queryExecution().optimizedPlan().toString() for x in links if x.columns[:2] == ["a", "b"]]
    assert keys and all("sheet" in line for k in keys for line in k.splitlines() if "Join Inner" in line)


def test_folding_pairs_against_a_new_search_after_each_merge():
    for seed in range(40):
        rng = random.Random(seed)
        boxes = [[r, r + rng.randrange(3), c, c + rng.randrange(4), 1, 0] for r, c in ((rng.randrange(25), rng.randrange(12)) for _ in range(30))]
        for near, test in ((R.met, meets), (R.adjacent, titled)):
            want = sorted((list(b) for b in boxes), key=lambda b: (b[0], b[2]))
            while pair := first_pair(want, test):
                want[pair[0]] = R.united(want[pair[0]], want.pop(pair[1]))
                want.sort(key=lambda b: (b[0], b[2]))
            R._fold_pairs(boxes, near, 0 if near is R.met else R.TITLE_GAP + 1)
            assert sorted(boxes) == sorted(want)
