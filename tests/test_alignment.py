import difflib
import random

from docloom.operators.alignment import operations, replayed, source_rows


def frame(spark, made):
    return spark.createDataFrame([(s, k, t) for s, x in made.items() for k, t in enumerate(x)], "sheet int, row long, text string").repartition(3)


def pairs(seed, many):
    rng = random.Random(seed)
    left, right = {}, {}
    for s in range(many):
        a = [rng.choice("abcdefgh") * rng.choice([1, 2]) for _ in range(rng.choice([0, 1, 8, 40]))]
        b = []
        for x in a:
            b += rng.choice([[x], [x], [x], [], ["new"], [x, "more"]])
        left[s], right[s] = a, b
    left[100], right[101] = ["only", "left"], ["only", "right"]
    return left, right


def test_like_the_library_and_replayed(spark):
    left, right = pairs(3, 25)
    a, b = frame(spark, left), frame(spark, right)
    ops = operations(a, b)
    got = {}
    for r in ops.orderBy("sheet", "k").collect():
        got.setdefault(r.sheet, []).append((r.tag, r.i1, r.i2, r.j1, r.j2))
    for s in left.keys() | right.keys():
        assert got.get(s, []) == difflib.SequenceMatcher(None, left.get(s, []), right.get(s, []), autojunk=False).get_opcodes()
    made = {}
    for r in replayed(ops, a, b).orderBy("sheet", "row").collect():
        made.setdefault(r.sheet, []).append(r.text)
    assert made == {s: x for s, x in right.items() if x}
    rows = {(r.sheet, r.row): r.source_row for r in source_rows(ops).collect()}
    for (s, i), j in rows.items():
        assert 0 <= i < len(left[s]) and 0 <= j < len(right[s])
    assert all(rows[s, i] == j1 + i - i1 for s, x in got.items() for tag, i1, i2, j1, j2 in x if tag == "equal" for i in range(i1, i2))


def test_white_space_case_nulls_and_empty(spark):
    a = spark.createDataFrame([(None, 0, "A b"), (None, 1, None), (1, 0, "x")], "sheet int, row long, text string")
    b = spark.createDataFrame([(None, 0, "ab"), (None, 1, "")], "sheet int, row long, text string")
    assert [tuple(r) for r in operations(a, b).orderBy("sheet").collect()] == [(None, 0, "equal", 0, 2, 0, 2), (1, 0, "delete", 0, 1, 0, 0)]
    assert operations(a.limit(0), b.limit(0)).collect() == []
