import random
from collections import Counter

import numpy as np
import xxhash

from docloom.llm.chunk_dedup import CALM, GEAR, MOST, ZERO_BITS, chunks, remove_repeats, repeats


def brute_chunks(raw: bytes):
    h, could = 0, []
    for i, b in enumerate(raw):
        h = ((h << 1) + int(GEAR[b])) & 0xFFFFFFFF
        if h >> (32 - ZERO_BITS) == 0:
            could.append(i + 1)
    cuts = {0, len(raw)} | {c for k, c in enumerate(could) if k == 0 or c - could[k - 1] >= CALM}
    out = set()
    for c in cuts:
        while c < len(raw) and raw[c] & 0xC0 == 0x80:
            c += 1
        out.add(c)
    cuts = sorted(out)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        for c in range(a + MOST, b, MOST):
            while c < len(raw) and raw[c] & 0xC0 == 0x80:
                c += 1
            out.add(c)
    cuts = sorted(out)
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def words(rnd, n):
    return " ".join("".join(rnd.choices("abcdeéghi", k=rnd.randint(2, 9))) for _ in range(n))


def test_chunks():
    rnd = random.Random(3)
    texts = [words(rnd, k) for k in (0, 1, 5, 300)] + ["", "é" * 5000, "a" * 3000]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    s, e = chunks(np.frombuffer(b"".join(raw), np.uint8), offs)
    want = [(a + o, b + o) for r, o in zip(raw, offs, strict=False) if r for a, b in brute_chunks(r)]
    assert list(zip(s.tolist(), e.tolist(), strict=True)) == want


def test_passages(spark):
    rnd = random.Random(4)
    passages = [words(rnd, 51) for _ in range(40)]
    docs, planted = [], set()
    for k in range(300):
        t = words(rnd, rnd.randint(1, 300))
        if k % 3 == 0:
            t = t + " " + passages[k % 40] + " " + words(rnd, 20)
            planted.add(k)
        docs.append((k, t))
    docs += [(1000, None), (1001, ""), (1002, "a"), (1003, docs[1][1]), (1004, docs[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r.doc: r for r in repeats(df).collect()}
    assert len(planted & set(found)) >= 0.97 * len(planted)
    assert set(found) - planted <= {1, 1003, 1004}
    if len(docs[1][1].encode()) >= 200:
        assert found[1].removed == 0 and found[1004].removed == len(docs[1][1].encode())
    kept = dict(remove_repeats(df).collect())
    assert set(kept) == {i for i, _ in docs} and kept[1000] is None
    for i, t in docs:
        if i not in found or not found[i].removed:
            assert kept[i] == t
        else:
            assert len(kept[i].encode()) == len(t.encode()) - found[i].removed


def brute_repeats(docs, least):
    """By chunks and their bytes themselves: {(doc, text): (repeated, removed, spans)}."""
    rows = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0))
    seen = Counter(raw[a:b] for i, t in docs for raw in [(t or "").encode()] for a, b in brute_chunks(raw))
    places = {}
    for i, t in rows:
        raw = (t or "").encode()
        for a, b in brute_chunks(raw):
            places.setdefault(raw[a:b], []).append((i is not None, i or 0, own(t), a))
    first = {c: min(p) for c, p in places.items()}
    out = {}
    for i, t in rows:
        raw, runs = (t or "").encode(), []
        for a, b in brute_chunks(raw):
            if seen[raw[a:b]] > 1:
                again = first[raw[a:b]] != (i is not None, i or 0, own(t), a)
                if runs and runs[-1][-1][1] == a:
                    runs[-1].append((a, b, again))
                else:
                    runs.append([(a, b, again)])
        runs = [r for r in runs if r[-1][1] - r[0][0] >= least]
        gone = sorted(x for r in runs for a, b, again in r if again for x in range(a, b))
        if runs:
            out[i, own(t)] = (sum(r[-1][1] - r[0][0] for r in runs), gone)
    return out


def own(t):
    return xxhash.xxh64_intdigest((t or "").encode(), 42) - (1 << 64 if xxhash.xxh64_intdigest((t or "").encode(), 42) >> 63 else 0)


def test_repeats_against_brute_force(spark):
    rnd = random.Random(6)
    parts = [words(rnd, k) for k in (3, 9, 20, 51, 90)] + ["é" * 1500]
    docs = [(k, " ".join(rnd.choice(parts) if rnd.random() < 0.5 else words(rnd, rnd.randint(0, 40)) for _ in range(rnd.randint(0, 6)))) for k in range(120)]
    docs += [docs[3], docs[3], (3, docs[9][1]), (None, docs[5][1]), (None, docs[7][1]), (700, None), (701, ""), (702, parts[4] * 40)]
    df = spark.createDataFrame([(*d, "r", 1) for d in docs], "doc_id long, text string, row string, starts int").repartition(5)
    for least in (1, 100):
        got = {(r.doc, r.own): (r.repeated, [x for a, b in zip(r.starts, r.ends, strict=True) for x in range(a, b)]) for r in repeats(df, least=least).collect()}
        assert got == brute_repeats(docs, least)
    kept = remove_repeats(df)
    assert kept.columns == df.columns
    want = {k: set(gone) for k, (_, gone) in brute_repeats(docs, 100).items()}

    def cut(i, t):
        gone = want.get((i, own(t)), ())
        return None if t is None else bytes(b for k, b in enumerate(t.encode()) if k not in gone).decode()

    assert sorted((str(r.doc_id), r.text or "", r.row, r.starts) for r in kept.collect()) == sorted((str(i), cut(i, t) or "", "r", 1) for i, t in docs)


def test_empty(spark):
    assert repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
