import hashlib
import random
from collections import Counter

import numpy as np

from docloom.llm import suffix_dedup as sd


def brute(docs):
    raw = [(i, (t or "").encode()) for i, t in docs]
    n = Counter(r[s : s + 200] for _, r in raw for s in range(len(r) - 199))
    out = Counter()
    for i, r in raw:
        gone = np.zeros(len(r), bool)
        for s in range(len(r) - 199):
            if n[r[s : s + 200]] > 1:
                gone[s : s + 200] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone]) if r else b""
        out[i, len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = ["the", "of", "élan", "with", "日本", "a", "ing", "er", "stone", "x"]
    passages = ["".join(rnd.choices("abcdé ", k=rnd.choice([150, 190, 199, 200, 201, 260, 500]))) for _ in range(8)]
    docs = []
    for k in range(90):
        t = " ".join(rnd.choices(words, k=rnd.choice([0, 5, 60, 200])))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            at = rnd.randrange(len(t) + 1)
            p = rnd.choice(passages)
            cut = rnd.choice([0, 0, rnd.randrange(60)])
            t = t[:at] + p[cut:] + t[at:]
        docs.append((k, t))
    return [*docs, (200, None), (201, ""), (202, "z" * 1000), (203, "ab" * 400), (204, docs[3][1]), (205, docs[3][1][:-1] + "!"), (206, "q" * 200), (207, "w" * 201), (3, docs[5][1]), (6, docs[6][1]), (None, docs[8][1]), (None, "v" * 300), (300, "n " * 3000 + docs[9][1])]


def test_suffix_array():
    rnd = random.Random(9)
    for k in (1, 5, 300, 2000):
        text = np.array([rnd.choice([1, 2, 3, 200]) for _ in range(k)] + [0], np.uint8)
        raw = text.tobytes()
        assert [raw[i:] for i in sd.suffix_array(text, 4096)] == sorted(raw[i:] for i in range(len(raw)))


def test_against_brute_force(spark):
    docs = corpus(1)
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, own int, raw string").repartition(3)
    for hot in (sd.HOT, 1):
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.suffix_dedup(df, hot=hot).collect())
        assert got == brute(docs)


def test_empty(spark):
    assert sd.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_hot_and_long():
    docs = corpus(2)
    contexts = []
    for _, t in docs:
        raw = (t or "").encode()
        contexts.append(raw)
    starts = [max(0, len(c) - 199) for c in contexts]
    n = Counter(c[s : s + 200] for c in contexts for s in range(len(c) - 199))
    for c, hit in zip(contexts, sd.repeated_starts(contexts, starts), strict=True):
        assert hit.tolist() == [n[c[s : s + 200]] > 1 for s in range(max(0, len(c) - 199))]
