import math
import random
import re
from collections import Counter

import duckdb

from docloom.llm import quality_rules as q

WORD = r"[^\x20\x09-\x0D]+"


def brute(t):
    t = t or ""
    w = re.findall(WORD, t)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def corpus():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(300)] + ["É", "日本", "a#b", "x|y", "\x00z"]
    docs = []
    for k in range(250):
        w = rnd.choices(words[: rnd.choice([3, 20, 305])], k=rnd.choice([0, 1, 2, 3, 60, 400]))
        t = "".join(x + rnd.choice([" ", " ", "  ", "\n", "\t", "\x0b", ". "]) for x in w)
        if k % 7 == 0:
            t = "".join(f"{x}{rnd.choice(['###', '$$$', '%%%'])} " for x in w)
        if k % 11 == 0:
            t = t.upper().replace(" ", "!! ")
        docs.append((k, t))
    return [*docs, (900, None), (901, ""), (902, "same line\n" * 4000), (903, docs[5][1]), (903, docs[5][1])]


def test_counts(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, *(r[c] for c in q.BASE)) for r in q.counts(df).collect())
    assert got == sorted((i, *brute(t)) for i, t in docs)


def test_junk_goes_and_clean_stays(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in corpus()], "doc_id long, text string, kept string, n_words string")
    rows = q.keep_good(docs).collect()
    assert all((r.kept, r.n_words) == ("x", "y") for r in rows)
    kept = {r.doc_id for r in rows}
    for i, t in corpus():
        n, _, symbols, _, rep = brute(t)
        if n < 50 or 100 * rep > 50 * n or symbols > n:
            assert i not in kept
    assert q.keep_good(docs.limit(0).select("doc_id", "text")).collect() == []


def test_labels(spark):
    """Rejects what the labels call bad, and keeps nearly all that they call good and that passes the base."""
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in q.op2_quality_rules(spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    assert not any(r.kept for r in rows if labels[r.doc_id] == 0)
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    assert sum(good) >= 0.98 * len(good)


def test_sql(spark):
    duckdb.sql("CREATE OR REPLACE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = {r[0]: r[1:] for r in duckdb.sql(f"SELECT doc_id, base_failed, kept FROM ({q.OP2_SQL})").fetchall()}
    got = {r.doc_id: (r.base_failed, r.kept) for r in q.op2_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_fit_is_expectation_maximisation(spark):
    """Against the same rounds in plain Python; and a rule that contradicts all others loses its weight."""
    rnd = random.Random(8)
    rows = []
    for k in range(3000):
        good = rnd.random() < 0.8
        v = [rnd.choice([1, 1, 1, 1, 1, 1, -1]) if good else rnd.choice([0, 0, 0, 1, -1]) for _ in q.RULES]
        v[2] = rnd.choice([0, 1])  # tells nothing
        rows.append((*v, 60))
    names = [f"v_{r[0]}" for r in q.RULES]
    cells = Counter(r[:-1] for r in rows)
    p = {v: q.WITH_BAD if 0 in v else q.WITHOUT_BAD for v in cells}
    for _ in range(q.ROUNDS):
        prior = (sum(n * p[v] for v, n in cells.items()) + q.PRIOR) / (len(rows) + 1)
        rate = []
        for k in range(len(names)):
            g = (sum(n * p[v] for v, n in cells.items() if v[k] == 0) + 1) / (sum(n * p[v] for v, n in cells.items() if v[k] >= 0) + 2)
            b = (sum(n * (1 - p[v]) for v, n in cells.items() if v[k] == 0) + 1) / (sum(n * (1 - p[v]) for v, n in cells.items() if v[k] >= 0) + 2)
            rate.append((g, b))
        for v in cells:
            odds = math.log(prior / (1 - prior))
            for x, (g, b) in zip(v, rate, strict=True):
                odds += math.log(g / b) if x == 0 else math.log((1 - g) / (1 - b)) if x == 1 else 0
            p[v] = 1 / (1 + math.exp(-odds))
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in names) + ", n_words int")
    real, q.votes = q.votes, lambda d: d
    try:
        model = q.fit(df)
    finally:
        q.votes = real
    assert abs(model["prior"] - prior) < 1e-9
    for c, (g, b) in zip(names, rate, strict=True):
        assert abs(model[c][0] - g) < 1e-9 and abs(model[c][1] - b) < 1e-9
    assert abs(model[names[2]][0] - model[names[2]][1]) < 0.1 < 0.5 < model[names[0]][1]


def test_repeated_null_and_empty_rows(spark):
    clean = " ".join("".join(random.Random(k).choices("abcdefgh", k=5)) + "." * (k % 9 == 8) for k in range(200))
    docs = [(1, clean), (1, clean), (None, clean), (2, None), (3, ""), (4, "word " * 200000)]
    kept = q.keep_good(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "1", "None"] and {r.text for r in kept} == {clean}
