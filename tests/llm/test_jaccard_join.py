import random
import re

import numpy as np

from docloom.llm.components import components
from docloom.llm.jaccard_join import jaccard_classes, one_of_each, shingle_sets


def brute(docs):
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a2, b2 = root(a), root(b)
                parent[max(a2, b2)] = min(a2, b2)
    return {(i, len(sets[i]), root(i)) for i in ids}


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Élan", "ÉLAN", "The"]
    passage = rnd.choices(words, k=60)
    docs, base = [], [rnd.choices(words, k=rnd.choice([4, 9, 30, 80, 200])) for _ in range(12)]
    for k in range(220):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        if rnd.random() < 0.2:
            at = rnd.randrange(len(w))
            w[at:at] = passage
        docs.append((k, rnd.choice([" ", "\n", "\t "]).join(w) if rnd.random() < 0.9 else " ".join(w).upper()))
    return [*docs, (900, None), (901, ""), (902, "  \n"), (903, "one"), (904, "One"), (905, "x " * 3000)]


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs = corpus(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        got = {tuple(r) for r in jaccard_classes(df).select("doc_id", "n_shingles", "component_id").collect()}
        assert got == brute(docs)
    kept = {r.doc_id for r in one_of_each(df).collect()}
    assert kept == {c for _, _, c in brute(docs)}


def test_listed_by_one_and_in_the_rest_of_the_other(spark):
    """a has 100 shingles and lists 15 of its own (rare) and t1..t6; b has 90, 5 of its own (common), and lists t1..t19; 85 are shared, as many as are needed.
    c lists t1..t6 too and is compared first with a and b, but its size rules links out."""
    shared, own_a, own_b, tail = ([f"{x}{k}" for k in range(n)] for x, n in (("p", 89), ("a", 15), ("b", 5), ("t", 300)))
    windows = [shared[k : k + 5] for k in range(85)]
    windows.sort(key=lambda w: next(shingle_sets(np.frombuffer((t := " ".join(w)).encode(), np.uint8), np.array([0, len(t)])))[0])
    docs = [(1, own_a + shared), (2, shared + own_b), (3, [x for k, w in enumerate(windows[:6]) for x in [*w, f"c{k}"]] + tail)]
    for k in range(30):  # make shared, own_b and tail ever more common; what they list is their own
        docs.append((10 + k, [f"f{k}-{j}" for j in range(500)] + (shared if k < 10 else []) + [f"g{k}"] + (shared[-4:] + own_b if 10 <= k else []) + [f"h{k}"] + tail))
    docs = [(i, " ".join(w)) for i, w in docs]
    got = {tuple(r) for r in jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == brute(docs) and {(1, 100, 1), (2, 90, 1)} <= got


def test_empty(spark):
    assert jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 90), (90, 95), (7, 7), (200, 200)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(51), 0), 90: 90, 95: 90, 100: 90, 200: 200}


def test_chains_repeated_rows_and_clashing_columns(spark):
    """Edits add up along a chain, so that hubs and followers of different hubs lie around the threshold; one text is hot."""
    rnd = random.Random(9)
    docs, w = [], [f"c{k}" for k in range(120)]
    for k in range(40):
        for _ in range(2):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        docs.append((k, " ".join(w)))
    docs += [(100 + k, " ".join(w[:110] + [f"z{k}"] * (k % 3))) for k in range(60)]
    docs += [(5, docs[5][1]), (300, None), (300, None)]
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, whole string, gone int, id int").repartition(6)
    assert {tuple(r) for r in jaccard_classes(df).collect()} == brute(docs)
    kept = one_of_each(df)
    assert kept.columns == df.columns and {(r.whole, r.gone, r.id) for r in kept.collect()} == {("x", 1, 2)}
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in brute(docs)}


def test_rows_of_one_id_and_without_one(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    docs = [(3, a), (5, a), (5, b), (None, a), (None, a), (7, c), (7, c), (None, "lone words"), (8, None), (8, ""), (None, None)]
    df = spark.createDataFrame([(*d, 4) for d in docs], "doc_id long, text string, row int").repartition(3)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    got = sorted((key((r.doc_id, r.n_shingles, r.component_id)) for r in jaccard_classes(df).collect()))
    assert got == sorted(key(x) for x in [(3, 26, 3), (5, 26, 3), (5, 26, 5), (None, 26, 3), (None, 26, 3), (7, 26, 7), (7, 26, 7), (None, 1, None), (8, 0, 8), (8, 0, 8), (None, 0, None)])
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(key((r.doc_id, r.text or "")) for r in kept.collect()) == sorted(key(x) for x in [(3, a), (5, b), (7, c), (None, "lone words"), (8, ""), (8, ""), (None, "")])


def test_repeated_ids_against_brute_force(spark):
    docs = [(i % 40 if i % 7 else None, t) for i, t in corpus(3)]
    rows = list(enumerate(docs))
    want = {r: (n, c) for r, n, c in brute([(r, t) for r, (_, t) in rows])}
    least = {}
    for r, (i, _) in rows:
        c = want[r][1]
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    key = lambda *x: tuple(-1 if v is None else v for v in x)
    got = sorted(key(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == sorted(key(i, want[r][0], least[want[r][1]]) for r, (i, _) in rows)
