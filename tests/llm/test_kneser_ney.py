import math
import random
import re
from collections import Counter, defaultdict

import pytest

from docloom.llm.kneser_ney import discounts, fit, score


def toks(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), "</s>"]


class Brute:
    def __init__(self, texts):
        self.pairs, self.uni = Counter(), Counter()
        for t in texts:
            w = toks(t)
            self.uni.update(w)
            self.pairs.update(zip(["<s>", *w[:-1]], w, strict=True))
        self.ctx = defaultdict(list)
        for (u, _), c in self.pairs.items():
            self.ctx[u].append(c)
        self.kinds = Counter(w for _, w in self.pairs)
        self.d = discounts([sum(c == k for c in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.e = discounts([sum(c == k for c in self.kinds.values()) for k in (1, 2, 3, 4)])
        self.n, self.v = sum(self.uni.values()), len(self.uni)

    def p(self, u, w):
        total = sum(self.kinds.values())
        rest = sum(self.e[min(c, 3) - 1] for c in self.kinds.values()) / total
        k = self.kinds[w]
        low = rest / (self.v + 1) + (max(k - self.e[min(k, 3) - 1], 0) / total if k else 0)
        if u not in self.ctx:
            return low
        s = sum(self.ctx[u])
        c = self.pairs[u, w]
        return (c - self.d[min(c, 3) - 1] if c else 0) / s + sum(self.d[min(x, 3) - 1] for x in self.ctx[u]) / s * low

    def score(self, t):
        w = toks(t)
        return sum(math.log10(self.p(u, x)) for u, x in zip(["<s>", *w[:-1]], w, strict=True)), sum(math.log10((self.uni[x] + 1) / (self.n + 1 * (self.v + 1))) for x in w), len(w), sum(self.uni[x] > 0 for x in w)


def test_against_brute_force(spark, monkeypatch):
    from docloom.llm import kneser_ney as kn

    monkeypatch.setattr(kn, "RANGE_BYTES", 2000)  # several ranges
    rnd = random.Random(1)
    vocab = [f"w{k}" for k in range(60)] + ["É", "The", "tHe"]
    weights = [1 / (k + 1) for k in range(len(vocab))]
    texts = [rnd.choice(["", " "]) + rnd.choice([" ", "\n"]).join(rnd.choices(vocab, weights, k=rnd.choice([0, 1, 5, 80]))) for _ in range(120)] + [None, ""]
    train, rest = texts[:100], texts[90:] + ["unknown words w1 here"]
    model = fit(spark.createDataFrame([(t,) for t in train], "text string").repartition(3))
    brute = Brute(train)
    assert (model["tokens"], model["vocabulary"]) == (brute.n, brute.v) and model["bits"] > 0
    got = {r.doc_id: r for r in score(spark.createDataFrame(list(enumerate(rest)), "doc_id long, text string"), model).collect()}
    for k, t in enumerate(rest):
        s, b, n, known = brute.score(t)
        assert got[k].score == pytest.approx(s, abs=1e-9) and got[k].base_score == pytest.approx(b, abs=1e-9)
        assert (got[k].n_tokens, got[k].n_known) == (n, known)
    # probabilities after a context add up to one
    words = [*brute.uni, "<unknown>"]
    for u in ("<s>", "w1", "never"):
        assert sum(brute.p(u, w) for w in words) == pytest.approx(1.0)


def test_base_adds_up_to_one(spark):
    """Add-one shares of all words and of an unknown one; each text is scored with the end of its text."""
    model = fit(spark.createDataFrame([("a b a",), ("c a",)], "text string"))  # a 3, b 1, c 1, end 2: 7 tokens of 4 words
    got = {r.doc_id: r.base_score for r in score(spark.createDataFrame([(0, ""), (1, "a"), (2, "b"), (3, "c"), (4, "new")], "doc_id long, text string"), model).collect()}
    assert got[0] == pytest.approx(math.log10(3 / 12))
    shares = [10 ** got[0], *(10 ** (got[k] - got[0]) for k in (1, 2, 3, 4))]
    assert shares == pytest.approx([3 / 12, 4 / 12, 2 / 12, 2 / 12, 1 / 12]) and sum(shares) == pytest.approx(1.0)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert score(none, fit(none.select("text"))).collect() == []
    one = score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), fit(none.select("text"))).first()
    assert one.score == 0.0 and one.n_tokens == 3


def test_perplexity_and_few_maps(spark, monkeypatch):
    """With fewer maps than the model has arrays, scores stay the same; perplexity is the inverse probability by token."""
    import numpy as np

    from docloom.llm import kneser_ney as kn

    docs = [(k, " ".join(f"w{(k * j) % 50}" for j in range(k % 40))) for k in range(200)] + [(7, "w1 w2"), (None, None)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3)
    model = kn.fit(df.select("text"))
    rows = kn.score(df, model).collect()
    assert len(rows) == len(docs) and all(abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in rows)
    want = {(r.doc_id, r.n_tokens): r.score for r in rows}
    monkeypatch.setattr(kn, "MAPS", 2)
    kn._maps.clear()
    batch = df.select("doc_id", "text").toArrow().combine_chunks().to_batches()
    for b in kn._score(model)(iter(batch)):
        for i, n, score in zip(b["doc_id"].to_pylist(), b["n_tokens"].to_pylist(), b["score"].to_pylist(), strict=True):
            assert np.isclose(want[i, n], score)
    assert len(kn._maps) <= 2
