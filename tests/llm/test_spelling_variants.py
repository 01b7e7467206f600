import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import pyarrow as pa

from docloom.llm import spelling_variants
from docloom.llm.spelling_variants import OP12_SQL, Trie, neighbours, op12_spelling_variants, variants, words_of


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_words(docs):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_forms(n):
    out = {}
    for w, k in n.items():
        near = [x for x in n if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 10 * k else None
        out[w] = (k, len(near), form, form and n[form])
    def root(w):
        return root(out[w][2]) if out[w][2] else w
    return {w: (*x, root(w)) for w, x in out.items()}


def some_words(many, letters="ab", least=7, most=10):
    return {"".join(random.choice(letters) for _ in range(random.randint(least, most))) for _ in range(many)}


def test_trie_against_all_pairs():
    random.seed(1)
    for letters, many in (("ab", 150), ("abcÿé", 300), ("a", 5)):
        words = sorted(x.encode("latin-1") for x in some_words(many, letters, 0, 8) if x)
        trie = Trie.unpack(Trie(words, [k + 1 for k in range(len(words))]).pack())
        for w in [*words, b"", b"abab", b"zz", b"a" * 9]:
            got = list(trie.near(w))
            assert sorted(got) == sorted((k + 1, x) for k, x in enumerate(words) if one_edit(w.decode("latin-1"), x.decode("latin-1")))


def test_trie_of_one_word_and_of_very_long_ones():
    assert list(Trie([b"abcdefg"], [3]).near(b"abcdefg")) == [] and list(Trie([b"abcdefg"], [3]).near(b"abcdefgh")) == [(3, b"abcdefg")]
    a, b = b"xy" * 500_000, b"xy" * 499_999 + b"x"
    assert list(Trie(sorted([a, b]), [5, 6]).near(a)) in ([(5, b)], [(6, b)])


def test_head_and_tail_find_each_neighbour_once():
    random.seed(3)
    for letters, many in (("ab", 150), ("abcÿé", 300), ("a", 5)):
        words = sorted(x.encode("latin-1") for x in some_words(many, letters, 0, 8) if x)
        ways = Trie(words, [1] * len(words)), Trie(sorted(w[::-1] for w in words), [1] * len(words))
        for w in [*words, b"", b"abab", b"zz", b"a" * 9]:
            for head in range(len(w) + 1):
                tail = [x for _, x in ways[0].near(w, head)]
                assert all(x.startswith(w[:head]) for x in tail)
                got = tail + [x for _, y in ways[1].near(w[::-1], len(w) - head) if not (x := y[::-1]).startswith(w[:head])]
                assert sorted(got) == sorted(x for _, x in ways[0].near(w))


def test_words_walk_few_shards_however_many_there_are(monkeypatch):
    random.seed(4)
    walked = []
    near = Trie.near
    monkeypatch.setattr(Trie, "near", lambda self, *a: walked.append(1) or near(self, *a))
    for before in ("", "sharedbyallwords" * 6):
        words = sorted(before + w for w in some_words(3000, "abcdefgh", 9, 9))
        sides = []
        for keys in (words, sorted(w[::-1] for w in words)):
            made = spelling_variants.shards(50, 1 << 20)(iter([pa.RecordBatch.from_arrays([pa.array(keys), pa.array([2] * len(keys))], names=["word", "n"])]))
            sides.append([tuple(x[c][0].as_py() for c in ("first", "last", "shard")) for x in made])
        assert min(map(len, sides)) >= 50
        ends = SimpleNamespace(value=[tuple(sorted(x[c].encode("latin-1") for x in side) for c in (0, 1)) for side in sides])
        (dealt,) = spelling_variants.dealing(ends)(iter([pa.RecordBatch.from_arrays([pa.array(words), pa.array([2] * len(words))], names=["word", "n"])]))
        walked.clear()
        found = Counter()
        for side, backward in zip(sides, (False, True), strict=True):
            (out,) = spelling_variants.searched(SimpleNamespace(value=side), backward)(iter([dealt.select(["word", "head"])]))
            found.update(dict(zip(out["word"].to_pylist(), out["n_near"].to_pylist(), strict=True)))
        assert len(walked) < 8 * len(words)
        every = Trie([w.encode() for w in words], [2] * len(words))
        assert dict(found) == {w: n for w in words if (n := len(list(near(every, w.encode()))))}


def test_against_brute_force_in_small_shards(spark):
    random.seed(2)
    words = {w: random.choice([2, 3, 20, 40, 500, 7000]) for w in some_words(400, "abé", 7, 8)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = brute_forms(words)
    for bounds in ({}, {"shard_words": 37, "group_bytes": 1}, {"shard_bytes": 100, "group_bytes": 9000}):
        got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in variants(df, **bounds).collect()}
        assert got == want
    assert any(x[2] and x[4] != x[2] for x in want.values())


def test_words_nulls_ties_repeats_and_clashing_columns(spark):
    docs = [(1, "Balance balance BALANCE Élancer ÉLANCER élancer"), (2, "balance, balance balence"), (2, "balance, balance balence"), (None, "balance balanse balanse"), (3, None), (4, ""), (5, "z" * 100_000 + " " + "z" * 100_000)]
    docs += [(k, " ".join(random.Random(k).choice(["overlap", "overlay", "overlapping", "short", "straße"]) for _ in range(50))) for k in range(10, 60)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    n = brute_words(docs)
    words = words_of(df)
    assert {r.word: r.n for r in words.collect()} == n
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in variants(words).collect()} == brute_forms(n)


def test_sql_and_query(spark, tmp_path):
    import duckdb

    words = list(some_words(40, "abcd", 5, 9))
    docs = [(k, " ".join(random.Random(k).choices(words, [1.6**j for j in range(len(words))], k=80))) for k in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(map(str, (tuple(r[c] for c in cols) for r in op12_spelling_variants(spark, str(tmp_path)).collect())))
    assert got == sorted(map(str, con.sql(f"SELECT {', '.join(cols)} FROM ({OP12_SQL})").fetchall()))
    want = brute_forms(brute_words(docs))
    assert got == sorted(str((w, f, r, k, m, fn)) for w, (k, m, f, fn, r) in want.items())


def test_empty(spark):
    assert variants(words_of(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
    assert neighbours(spark.createDataFrame([("abcdefg", 2)], "word string, n long")).collect()[0].n_near == 0
