import random

from docloom.llm.decontamination import drop_contaminated, leaks, tile


def brute_tiles(doc, item, least=5):
    """The longest match that does not overlap a tile, again and again."""
    a, b, out = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return out
        a[i : i + k], b[j : j + k] = [True] * k, [True] * k
        out.append((i, j, k))


def test_tiles():
    rnd = random.Random(1)
    for _ in range(60):
        item = [rnd.randrange(9) for _ in range(rnd.randint(5, 40))]
        doc = [rnd.randrange(9) for _ in range(30)] + item[len(item) // 2 :] + [rnd.randrange(9) for _ in range(5)] + item[: len(item) // 2]
        assert sorted(tile(doc, item)) == sorted(brute_tiles(doc, item))


def test_match_cut_short_by_a_longer_tile():
    item = [*range(17), 0, 18, 19]  # word 17 equals word 0: the first match runs one word over the seam
    doc = item[10:17] + item[:9]
    assert sorted(tile(doc, item)) == sorted(brute_tiles(doc, item)) == [(0, 10, 7), (7, 0, 9)]
    rnd = random.Random(3)
    for _ in range(300):
        item = [rnd.randrange(12) for _ in range(rnd.randint(10, 40))]
        cuts = sorted(rnd.sample(range(len(item)), 3))
        parts = [item[a:b] for a, b in zip([0, *cuts], [*cuts, len(item)], strict=True)]
        rnd.shuffle(parts)
        doc = [w for p in parts for w in p]
        assert sorted(tile(doc, item)) == sorted(brute_tiles(doc, item))


def test_reordered_passages(spark):
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(500)]
    items = [(k, " ".join(rnd.choices(words, k=36))) for k in range(30)] + [(90, None), (91, ""), (92, "too few words")]
    docs, planted = [], {}
    for k in range(200):
        w = rnd.choices(words, k=rnd.randint(0, 200))
        if k % 5 == 0:
            i = rnd.randrange(30)
            p = items[i][1].split()
            cut = rnd.randint(6, 30)
            w = [*w[: len(w) // 2], *(p[cut:] if k % 10 else p), *w[len(w) // 2 :], "gap", *(p[:cut] if k % 10 else [])]
            planted[k] = i
        docs.append((k, "\n".join(w).upper() if k % 3 else " ".join(w), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (902, "too few words", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.found] for r in leaks(df, bench).collect()}
    assert {k: v[0] for k, v in got.items()} == planted
    assert {r.doc_id for r in drop_contaminated(df, bench).collect()} == {d[0] for d in docs} - set(planted)
    assert leaks(df.limit(0), bench).collect() == [] and leaks(df, bench.limit(0)).collect() == []


def brute_leaks(docs, items):
    """Every document against every item, by the definition of tiling; without the seeds' help."""
    out = []
    for i, t in docs:
        w, found = (t or "").lower().split(), []
        for j, x in items:
            x = (x or "").lower().split()
            tiles = brute_tiles(w, x) if len(x) >= 5 else []
            share = sum(k for _, _, k in tiles) / len(x) if tiles else 0
            if share >= 0.5:
                found.append((j, share, ",".join(f"{a}:{a + k}" for a, _, k in sorted(tiles))))
        if found:
            out.append((i, sorted(found)))
    return sorted(out)


def test_leaks_against_brute_force(spark):
    rnd = random.Random(7)
    words = [f"w{k}" for k in range(14)]  # few words, so that passages repeat and overlap
    hot = rnd.choices(words, k=9)
    items = [(k, " ".join([*(hot if k % 3 else []), *rnd.choices(words, k=rnd.randint(3, 22))])) for k in range(12)]
    items += [(3, items[3][1]), (50, items[4][1]), (51, "the " * 12), (52, None)]
    docs = []
    for k in range(50):
        w = [*hot] if k % 2 else []
        for _ in range(rnd.randint(0, 4)):
            x = rnd.choice(items[:12])[1].split()
            a = rnd.randrange(len(x))
            w += x[a : a + rnd.randint(1, 14)] + rnd.choices(words, k=rnd.randint(0, 3))
        docs.append((k, " ".join(w)))
    docs += [docs[7], docs[9], (7, docs[8][1]), (60, "the " * 30), (61, None), (62, "")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, whole string, digest int").repartition(4)
    got = sorted((r.doc_id, [tuple(x) for x in r.found]) for r in leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect())
    want = brute_leaks(docs, items)
    assert got == want and len(want) > 10
    texts = dict(enumerate(t for _, t in docs))
    bad = {t for i, _ in want for j, t in docs if j == i and brute_leaks([(j, t)], items)}
    kept = drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted((i, t or "") for i, t in docs if t not in bad) and len(texts) == len(docs)


def test_very_long_text(spark):
    item = [f"i{k}" for k in range(40)]
    docs = [(1, "the cat " * 100000 + " ".join(item[:20]) + " x " + "the " * 1000 + " ".join(item[20:])), (2, "the cat " * 100000)]
    items = [(1, " ".join(item)), (2, " ".join(["the cat"] * 20))]
    got = {r.doc_id: [(x.item_id, x.coverage) for x in r.found] for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: [(1, 1.0), (2, 1.0)], 2: [(2, 1.0)]}
