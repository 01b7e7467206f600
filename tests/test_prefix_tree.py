from docloom.operators.prefix_tree import tree

SCHEMA = "sheet string, no string, label string, value long, at long"


def test_phantoms_and_roll_ups(spark):
    rows = [("s", "1.2.3", "deep", 5, 1), ("s", "1.2.3", "later", 7, 2), ("s", "1.10", "ten", 1, 3), ("s", "2", None, None, 4), ("s", "x", "no", 1, 5), ("s", None, "no", 1, 6), ("s", "1.", "no", 1, 7), ("s", "1.2.3\n", "no", 1, 7), (None, "1.2", "other", 2, 8)]
    got = {(r.sheet, r.node): r for r in tree(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {("s", "1"), ("s", "1.2"), ("s", "1.2.3"), ("s", "1.10"), ("s", "2"), (None, "1"), (None, "1.2")}
    assert {k for k, r in got.items() if r.phantom} == {("s", "1"), ("s", "1.2"), (None, "1")}
    one, deep = got["s", "1"], got["s", "1.2.3"]
    assert (one.n_children, one.n_rows, one.total, one.parent, one.depth, one.breadcrumb) == (2, 2, 8, None, 1, "")
    assert (deep.label, deep.total, deep.parent, deep.depth, deep.breadcrumb) == ("later", 7, "1.2", 3, "1: > 1.2:")
    assert got["s", "2"].total is None and not got["s", "2"].phantom and got[None, "1"].total == 2
    assert tree(spark.createDataFrame([], SCHEMA)).collect() == []


def test_walked_and_added_up_trees_are_the_same(spark, monkeypatch):
    import random

    from docloom.operators import prefix_tree as P

    rng = random.Random(3)
    no = lambda: ".".join(str(rng.choice([1, 2, 10, 11])) for _ in range(rng.randint(1, 5)))
    rows = [(rng.choice([None, "a", "b"]), no(), rng.choice([None, "x", "y", ""]), rng.choice([None, 1, 5]), rng.randrange(9)) for _ in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {}
    for bound in (-1, 20, 1_000_000):
        monkeypatch.setattr(P, "TOGETHER", bound)
        got[bound] = sorted(map(repr, tree(df).collect()))
    assert len(got[-1]) > 100 and got[-1] == got[20] == got[1_000_000]
    # one shuffle of rows, no join
    plan = tree(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Generate") == 0
