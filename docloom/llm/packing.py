"""Packing into sequences by bounded-space online packing.

Each partition keeps a fixed number of open windows. A document's last, partial piece goes to the open window that it fits best; where it fits none, the
fullest window is emitted and a new one opened. Whole windows' worth of a long document are sequences at once. What is left open in the partitions is
merged in rounds of ever fewer, larger groups; only then are documents cut to fill windows, and the last one is cut at powers of two, so that little is padded.

Defined cases: null and empty texts are one end token; texts may be of any length; repeated rows (of one id, too) are packed one by one; ties in fit go to the
window opened first; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb
from .store import stash

LENGTH = 4096
OPEN = 64
END = 2
#: Words whose ids a worker remembers; beyond it the memory starts anew.
REMEMBER = 1_000_000
TOKENIZER = "word_bpe_49k.json"
#: New words encoded in one call, and what stands between them.
TOGETHER, MARK = 512, "^"

#: Partitions, or groups of them, whose open windows are merged in one task: 32 x 64 windows of 16 kB.
MERGE = 32
#: A sequence's id: round of the merge (6 bits), partition or group (24), number within it (28).
ID_BITS, GROUP_BITS = 28, 24

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


class WordTokens:
    """Ids of whole texts, word by word: the tokenizer drops white space and never joins across it, so each distinct word needs encoding once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # words are encoded many at a time with a mark between them, a word that has one id and is part of no other word encoded with it
        one = self._one(MARK)
        self.mark = one[0] if len(one) == 1 and self._one(f"{MARK} {MARK}") == one * 2 else None
        self.blind = all(self._one(c) == self._one(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        self.reset()

    def _one(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and the number of each word's ids."""
        ids, n = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), TOGETHER):
            part = words[k : k + TOGETHER]
            text = f"\n{MARK}\n".join(part)
            if self.mark is None or text.count(MARK) >= len(part):  # a word holds the mark
                got = [self._one(w) for w in part]
                ids.append(np.fromiter((i for x in got for i in x), np.uint32))
                n.append(np.fromiter(map(len, got), np.int64, len(got)))
                continue
            got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            marks = got == self.mark
            at = np.concatenate([[-1], np.flatnonzero(marks), [len(got)]])
            ids.append(got[~marks])
            n.append(np.diff(at) - 1)
        return np.concatenate(ids), np.concatenate(n)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after another, and each row's first id (length rows + 1)."""
        if self.blind:
            buf = tb.LOWER[buf]
        starts, ends, first = tb.word_bounds(buf, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        h = tb.PrefixHash(buf).of(starts, ends)
        keys, one, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBER:
            self.reset()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            raw = buf.tobytes()
            s, e = starts[one[new]], ends[one[new]]
            ids, n = self.encode_words([raw[i:j].decode("utf-8") for i, j in zip(s.tolist(), e.tolist(), strict=True)])
            at = len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, ids])
            where = place[new]
            self.keys, self.at, self.n = (np.insert(x, where, y) for x, y in ((self.keys, keys[new]), (self.at, at), (self.n, n)))
            place = np.searchsorted(self.keys, keys)
        at, n = self.at[place][back], self.n[place][back]
        total = np.concatenate([[0], np.cumsum(n)])
        out = self.ids[np.repeat(at - total[:-1], n) + np.arange(total[-1])]
        return out, total[first]


_tokens: dict[str, WordTokens] = {}


def tokens_of(path: str) -> WordTokens:
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


class Windows:
    """The open windows of one partition or group. A piece is (doc_id, start, ids as bytes, doc_tokens); an item is a list of pieces that stay together if they can."""

    def __init__(self, round_: int, group: int, most: int, length: int):
        self.next, self.most, self.length = ((round_ << GROUP_BITS) + group) << ID_BITS, most, length
        self.open: dict[int, list[tuple]] = {}  # window -> pieces
        self.used: list[tuple[int, int]] = []  # (tokens, - window) of the open windows, sorted: of equally full ones the first opened comes last

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, item: list[tuple], n: int) -> Iterator[tuple]:
        """Places an item of n tokens; yields the rows of windows that this fills."""
        while n:
            fits = bisect.bisect_right(self.used, (self.length - n, 1)) - 1
            rest: list[tuple] = []
            if fits >= 0:  # the window with the least room that is enough
                used, w = self.used.pop(fits)
            elif len(self.used) < self.most and n <= self.length:
                used, w = 0, -self.new()
            else:  # the fullest is topped up with the head of the item, and emitted
                used, w = self.used.pop() if self.used else (0, -self.new())
                item, rest = split(item, self.length - used)
            put = min(n, self.length - used)
            pieces = self.open.setdefault(-w, [])
            pieces.extend(item)
            if used + put == self.length:
                yield from rows(-w, self.open.pop(-w))
            else:
                bisect.insort(self.used, (used + put, w))
            item, n = rest, n - put

    def left(self) -> Iterator[tuple]:
        for w, pieces in self.open.items():
            yield from rows(w, pieces, keep=True)

    def finish(self) -> Iterator[tuple]:
        """All open windows end to end, cut into whole sequences, and the remainder at powers of two."""
        rest = [p for pieces in self.open.values() for p in pieces]
        n = sum(len(p[2]) // 4 for p in rest)
        while n:
            size = self.length if n >= self.length else 1 << (n.bit_length() - 1)
            head, rest = split(rest, size)
            n -= size
            yield from rows(self.new(), head)


def split(pieces: list[tuple], n: int) -> tuple[list[tuple], list[tuple]]:
    """The first n tokens, and the rest."""
    head: list[tuple] = []
    for k, (doc, start, raw, total) in enumerate(pieces):
        if n == 0:
            return head, pieces[k:]
        m = len(raw) // 4
        if m > n:
            return [*head, (doc, start, raw[: 4 * n], total)], [(doc, start + n, raw[4 * n :], total), *pieces[k + 1 :]]
        head.append(pieces[k])
        n -= m
    return head, []


def rows(window: int, pieces: list[tuple], keep: bool = False) -> Iterator[tuple]:
    offset = 0
    for doc, start, raw, total in pieces:
        n = len(raw) // 4
        yield doc, start, n, zlib.crc32(raw), total, window, offset, raw if keep else None
        offset += n


def batch_of(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [[]] * len(NAMES)
    kinds = [pa.int64()] * 7 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=NAMES)


def packer(path: str, length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, at = tokens_of(path), Windows(0, TaskContext.get().partitionId(), most, length)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, hi, buf, offs in tb.slices(batch.column(1)):
                out: list[tuple] = []
                got, first = enc.encode(buf, offs)
                raw, first = got.astype("<u4").tobytes(), (4 * first).tolist()
                for k in range(hi - lo):
                    own = raw[first[k] : first[k + 1]] + end
                    total = len(own) // 4
                    whole = total // length * length
                    for s in range(0, whole, length):
                        out.extend(rows(at.new(), [(ids[lo + k], s, own[4 * s : 4 * (s + length)], total)]))
                    if whole < total:
                        out.extend(at.add([(ids[lo + k], whole, own[4 * whole :], total)], total - whole))
                yield batch_of(out)
        yield batch_of(list(at.left()))

    return run


def merger(round_: int, length: int, most: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        at = Windows(round_, key[0].as_py(), most, length)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        items: dict[int, list] = {}
        for r in table.select(["doc_id", "start", "ids", "doc_tokens", "sequence_id"]).to_pylist():
            items.setdefault(r["sequence_id"], []).append((r["doc_id"], r["start"], r["ids"], r["doc_tokens"]))
        out = [x for item in items.values() for x in at.add(item, sum(len(p[2]) // 4 for p in item))]
        out.extend(at.finish() if last else at.left())
        return pa.Table.from_batches([batch_of(out)])

    return run


def pack(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, most: int = OPEN, merge: int = MERGE) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Texts are read once and never shuffled; a merge moves `most` windows a partition."""
    made = stash(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(packer(path, length, most), SCHEMA), "packed")
    done, round_, group = [made.filter("ids IS NULL")], 0, F.shiftright(F.col("sequence_id"), ID_BITS).bitwiseAND(F.lit((1 << GROUP_BITS) - 1))
    while True:
        round_ += 1
        groups = (made.filter("ids IS NOT NULL").agg(F.max(group)).first()[0] or 0) // merge + 1
        open_ = made.filter("ids IS NOT NULL").withColumn("group", F.floor(group / merge).cast("long"))
        made = stash(open_.groupBy("group").applyInArrow(merger(round_, length, most, groups == 1), SCHEMA), "packed")
        done.append(made.filter("ids IS NULL"))
        if groups == 1:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("ids")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(TOKENIZER))
