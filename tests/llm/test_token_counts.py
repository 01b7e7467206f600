import random

import public_tokenizers
from tokenizers import Tokenizer

from docloom.llm.token_counts import BLOCK, TOKENIZER, Counter, count_tokens, whole_tokens

PATH = public_tokenizers.path(TOKENIZER)


def test_like_the_library(spark):
    random.seed(3)
    parts = ["the", " the", "<|endoftext|>", "<|endoftext", "'ll", "'LL", " don't", "Émile", "日本語", "١٢٣", " ", "  ", "\n", "\t\n ", " ", " ", "​", "́", "Ⅷ", "½", "🙂", "#$%", "x" * 300, "İ", "\x00", "Ᲊ", "Ꟛ", "　", "\x85", "\x1c", "12345", "zq" * 9, "�", "𞄀"]
    docs = [(k, "".join(random.choice(parts) for _ in range(random.choice([0, 1, 3, 40, 700])))) for k in range(200)]
    docs += [(None, None), (None, ""), (7, "again"), (7, "again"), (901, "long words " * BLOCK), (902, "y" * 300_000), (903, " " * 200_000 + "a")]
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n_tokens int").repartition(5)
    tok = Tokenizer.from_file(PATH)
    want = sorted((i or -1, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in docs)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, PATH).collect()) == want


def test_whole_tokens_are_proven_and_others_are_not():
    tok, whole = Tokenizer.from_file(PATH), set(whole_tokens(PATH))
    assert {" the", "the", "\n\n", " don"} <= whole and "<|endoftext|>" not in whole
    assert all(len(tok.encode(w, add_special_tokens=False).ids) == 1 for w in sorted(whole)[::50] if not w.isspace())
    counter = Counter(PATH, whole)
    assert counter.count("the the zzqqj") == (len(tok.encode("the the zzqqj").ids), 2)


def test_a_code_point_that_is_cut_otherwise_goes_to_the_library():
    counter, tok = Counter(PATH, whole_tokens(PATH)), Tokenizer.from_file(PATH)
    counter.other.add("é")
    assert counter.count("né the é") == (len(tok.encode("né the é").ids), 0)


def test_all_code_points_are_compared():
    import numpy as np

    counter, tok = Counter(PATH, whole_tokens(PATH)), Tokenizer.from_file(PATH)
    points = np.array([c for c in range(0x30000) if not 0xD800 <= c < 0xE000])
    text = "".join(f"a{chr(c)}1" for c in points.tolist())
    assert counter.count(text)[0] == len(tok.encode(text, add_special_tokens=False).ids)


def test_empty(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
