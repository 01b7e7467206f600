import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from docloom.llm.packing import TOKENIZER, Windows, WordTokens, pack

PATH = public_tokenizers.path(TOKENIZER)


def check(rows, docs, length):
    tok = Tokenizer.from_file(PATH)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs}
    per, seqs = {}, {}
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id]) and len(ids) == r.length
        per.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(per) == set(want)
    for i, pieces in per.items():
        at = 0
        for s, n in sorted(pieces):
            assert s == at
            at += n
        assert at == len(want[i])
    pad = 0
    for pieces in seqs.values():
        at = 0
        for s, n in sorted(pieces):
            assert s == at
            at += n
        assert at <= length
        pad += 0 if at & (at - 1) == 0 else length - at
    assert pad == 0


def test_exact_cover(spark):
    random.seed(5)
    words = ["^", "a^b", "ALPHA", "İx", "alpha", "Émile", "it's", "x" * 300, "12,5", "ΑΣ", "don't", "###", " nb", "a b", "日本", "é"]
    docs = [(k, " ".join(random.choice(words) + random.choice(["", "\n", "\t "]) for _ in range(random.choice([0, 1, 7, 60, 900])))) for k in range(150)]
    docs += [(900, None), (901, ""), (902, "word " * 5000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    for most, merge in ((3, 2), (64, 32)):
        check(pack(df, PATH, length=256, most=most, merge=merge).collect(), docs, 256)


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_words_encoded_together():
    enc, tok = WordTokens(PATH), Tokenizer.from_file(PATH)
    words = [w for k in range(700) for w in (f"w{k}", f"é{k},", f"{k}'s", "^" * (k % 2) + "x")]
    ids, n = enc.encode_words(words)
    want = [tok.encode(w, add_special_tokens=False).ids for w in words]
    assert n.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_ties_go_to_the_window_opened_first():
    at = Windows(0, 0, 2, 8)
    piece = lambda k, n: [(k, 0, bytes(4 * n), n)]
    out = [*at.add(piece(1, 5), 5), *at.add(piece(2, 5), 5), *at.add(piece(3, 3), 3)]
    assert [(r[0], r[5]) for r in out] == [(1, 0), (3, 0)]  # both windows have room for three
    assert [*at.add(piece(4, 7), 7)] == [] and [(r[0], r[1], r[2]) for r in at.add(piece(5, 4), 4)] == [(4, 0, 7), (5, 0, 1), (2, 0, 5), (5, 1, 3)]


def test_repeated_rows_and_clashing_columns(spark):
    docs = [(1, "one two " * 40, "s"), (1, "one two " * 40, "s"), (None, "three", "t")]
    df = spark.createDataFrame(docs, "doc_id long, text string, sequence_id string")
    got = pack(df, PATH, length=64).collect()
    assert sum(r.length for r in got) == 2 * 81 + 2 and {r.doc_id for r in got} == {1, None}
