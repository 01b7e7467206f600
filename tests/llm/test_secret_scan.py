import random
import re

from docloom.llm import secret_scan as s

BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def brute(t):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, t or "") if ok(m)]
    return ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def corpus():
    rnd = random.Random(6)
    parts = ["password", "PassWD", "secret", "toKen", "apikey", "API_KEY", ":", "=", " = ", "'", '"', "token: ", "abcdef", "abc", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "é", "😀", "\n", " ", "deadbeef", "x", "==", "://user:pw12@", "ghp_" + "a" * 36]
    docs = [(k, "".join(rnd.choices(parts, k=rnd.randint(0, 25)))) for k in range(600)]
    return [*docs, (9000, None), (9001, ""), (9002, "password: token: abcdefgh"), (9003, "token=token=abcdef"), (9004, "f" * 50000), (9005, docs[0][1]), (9005, docs[0][1]), (9006, "token=abcdefg"), (9006, "nothing"), (None, "password = abcdefgh"), (None, None), (9007, "x y " * 300000 + "secret: abcdefgh")]


def test_base_spans(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "extra", 1, "k") for i, t in docs], "doc_id long, text string, m string, rules int, key string").repartition(3)
    for most in (0, 10**6):
        found = s.scan(df, broadcast_candidates=most).collect()
        got = sorted((str(r.row.doc_id), ",".join(f"{s.RULES[x.k].kind}:{x.s}:{x.e}" for x in r.spans if x.k < 3)) for r in found)
        assert got == sorted((str(i), brute(t)) for i, t in docs)
        assert {(r.row.m, r.row.rules, r.row.key) for r in found} == {("extra", 1, "k")}
    assert s.scan(df.limit(0)).collect() == []


def test_many_rules(spark):
    """More trigrams than one word of bits holds, and a rule without any."""
    rules = tuple(s.Rule(f"r{k}", f"key{k:03d}[a-z]+") for k in range(150)) + (s.Rule("any", "[xz]+"),)
    docs = [(k, f"a key{k:03d}abc and key{(7 * k) % 150:03d}d xz") for k in range(150)]
    for r in s.scan(spark.createDataFrame(docs, "doc_id long, text string"), rules).collect():
        want = sorted((m.start(), k, m.end()) for k, x in enumerate(rules) for m in re.finditer(x.pattern, docs[r.row.doc_id][1]))
        assert [tuple(x) for x in r.spans] == want


def test_queries_demand_what_matches_hold():
    def holds(q, low):
        return q is True or (q in low if isinstance(q, str) else (all if q[0] == "and" else any)(holds(x, low) for x in q[1]))

    for r in s.RULES:
        query = s.trigram_query(r.pattern)
        assert (query is True) == (r.kind == "hex")
        for _, t in corpus():
            for m in re.finditer(r.pattern, t or ""):
                assert holds(query, m[0].lower())


def test_very_many_matches(spark):
    """Every length of a block of matches, and 200,000 matches in one text."""
    docs = [(k, f"token=abcdef{k} é " * n) for k, n in enumerate([1, 511, 512, 513, 1024, 1025, 3000, 200000])]
    for r in s.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        assert [(x.s, x.k, x.e) for x in r.spans if x.k < 3] == [(m.start(), 0, m.end()) for m in re.finditer(BASE[0][1], docs[r.row.doc_id][1])]


def test_candidates_are_what_the_queries_say(spark):
    """Against the queries evaluated text by text, with shared parts and a query of one trigram only."""
    def holds(q, low):
        return q if q is True else q in low if isinstance(q, str) else (all if q[0] == "and" else any)(holds(x, low) for x in q[1])

    rules = (*s.RULES, s.Rule("deep", "(abc[0-9]+def|(ghij|klmn)[0-9]+opq)[a-z]*xyz"), s.Rule("same", "AKIA[0-9]+"))
    rnd = random.Random(4)
    parts = ["abc", "def", "ghij", "klmn", "opq", "xyz", "akia", "token", "passwd", "pas", "swd", "7", " ", "--begin", "private key"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(k % 350, texts[k % 350]) for k in range(400)], "key long, text string").repartition(4)
    want = {k: w for k, t in enumerate(texts[:350]) if (w := [n for n, r in enumerate(rules) if (q := s.trigram_query(r.pattern)) is not True and holds(q, t)])}
    got = s.candidates(df, rules).collect()
    assert len(got) == len(want) > 100 and {r.of: list(r.rules) for r in got} == want
    assert any(8 in w for w in want.values()) and s.candidates(df, (s.RULES[2],)).collect() == []
