"""Token counts of whole texts by the whole-token shortcut.

Before any text is read, each vocabulary string is put through the merges: those that come out as one token are proven whole (`whole_tokens`). A text is cut into
pre-tokens as the tokenizer cuts it; a pre-token that is proven whole counts one at once, and only the others are merged, each distinct one once per worker.

The cut is made by a regular expression whose character classes may be of another Unicode version than the tokenizer's. So each code point is compared with the
tokenizer's own cut when a worker first meets it, and a text with one that is cut otherwise goes to the tokenizer whole.

Defined cases: null and empty texts have no bytes and no tokens; special strings inside a text are one token each; texts may be of any length (long ones are cut
piece by piece); repeated rows and null ids are counted row by row; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import small_batches

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
#: How a byte-level tokenizer of this kind cuts its pre-tokens: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Merged pre-tokens that a worker remembers, and the longest of them; beyond the first the memory starts anew.
REMEMBER, LONGEST = 500_000, 64
#: Pre-tokens of a text that are held at once.
BLOCK = 1 << 16

SCHEMA = "doc_id long, n_bytes long, n_tokens long, n_whole long"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 characters for themselves, the others from U+0100 upwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}


_LETTERS = byte_letters()
_LATIN = str.maketrans({chr(b): c for b, c in _LETTERS.items()})


def in_letters(text: str) -> str:
    return text.encode("utf-8").decode("latin-1").translate(_LATIN)


def load(path: str):
    """The tokenizer, and its special strings. Only byte-level ones without normalizer are known to be cut by PATTERN."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    pre, added = made["pre_tokenizer"] or {}, made["added_tokens"]
    if made["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or made["model"]["type"] != "BPE" or made["model"].get("dropout") or any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added):
        raise ValueError(f"{path} is no plain byte-level tokenizer")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, sorted((x["content"] for x in added), key=len, reverse=True)


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings that the merges turn into one token, as text. Strings that are no whole UTF-8 characters are never a pre-token."""
    tokenizer, special = load(path)
    back = {c: b for b, c in _LETTERS.items()}
    out = []
    for letters, i in tokenizer.get_vocab(with_added_tokens=False).items():
        if letters in special or not all(c in back for c in letters):
            continue
        try:
            text = bytes(back[c] for c in letters).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if [t.id for t in tokenizer.model.tokenize(letters)] == [i]:
            out.append(text)
    return sorted(out)


class Counter(dict):
    """Number of tokens of a pre-token. Whole ones are there from the beginning, the others are merged when they are first asked for."""

    def __init__(self, path: str, whole: Iterable[str]):
        import regex

        self.tokenizer, special = load(path)
        self.cut = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.whole = dict.fromkeys(whole, 1)
        self.update(self.whole)
        self.agreed, self.other = np.zeros(0x110000, bool), set()
        self.agreed[:128] = True
        self.learn(np.arange(128))

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.model.tokenize(in_letters(piece)))
        if len(piece) <= LONGEST:
            if len(self) > REMEMBER + len(self.whole):
                self.clear()
                self.update(self.whole)
            self[piece] = n
        return n

    def learn(self, points: np.ndarray) -> None:
        """Which of these code points does the tokenizer cut otherwise? Each stands beside a letter, a digit, a sign and white space."""
        for c in map(chr, points.tolist()):
            text = f"a{c}a1{c}1!{c}! {c} {c}{c}\n{c}"
            if [in_letters(x) for x in self.cut.findall(text)] != [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]:
                self.other.add(c)
        self.agreed[points] = True

    def strange(self, text: str) -> bool:
        if not text.isascii():
            for k in range(0, len(text), BLOCK):
                points = np.frombuffer(text[k : k + BLOCK].encode("utf-32-le"), np.uint32)
                new = points[~self.agreed[points]]
                if len(new):
                    self.learn(np.unique(new))
        return bool(self.other) and any(c in text for c in self.other)

    def plain(self, text: str) -> tuple[int, int]:
        """(tokens, whole ones) of a text without special strings."""
        if len(text) <= BLOCK:
            n = [self[x] for x in self.cut.findall(text)]
            return sum(n), n.count(1)
        pieces, tokens, whole = (m.group() for m in self.cut.finditer(text)), 0, 0
        while block := [self[x] for x in islice(pieces, BLOCK)]:
            tokens, whole = tokens + sum(block), whole + block.count(1)
        return tokens, whole

    def count(self, text: str) -> tuple[int, int]:
        if self.strange(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids), 0
        if not self.special or not self.special.search(text):
            return self.plain(text)
        tokens = whole = at = 0
        for m in self.special.finditer(text):
            n, w = self.plain(text[at : m.start()])
            tokens, whole, at = tokens + n + 1, whole + w, m.end()
        n, w = self.plain(text[at:])
        return tokens + n, whole + w


_counters: dict[str, Counter] = {}


def counted(path: str, whole):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path, whole.value)
        of = _counters[path].count
        for batch in batches:
            texts = batch.column(1)
            got = [of(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([n for n, _ in got], pa.int64()), pa.array([w for _, w in got], pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "n_whole"])

    return run


def count_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_whole (pre-tokens that are one token). Texts are read once, row by row, and never shuffled; the vocabulary is broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    whole = spark.sparkContext.broadcast(whole_tokens(path))  # no larger than the vocabulary
    t = F.col(text).cast("string")
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("text"), F.coalesce(F.octet_length(t), F.lit(0)).cast("long").alias("n_bytes")).mapInArrow(counted(path, whole), SCHEMA)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(TOKENIZER))
