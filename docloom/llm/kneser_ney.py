"""Language-model scoring: an interpolated modified Kneser-Ney model over pairs of words, counted in Spark.

Each task counts the pairs of its texts and sends them packed, one row for each range of contexts. A range's counts are added up and written as sorted arrays
of hashes with their discounted shares; workers map these files into memory and look pairs up by binary search. A second, much smaller round
does the same for the words: in how many contexts each occurs. What is gathered grows with the corpus: no pruning, no caps.

Defined cases: null and empty texts are one end token; A-Z are lower-cased; unknown words share the uniform rest; texts may be of any length; repeated rows
are each counted and scored; an empty table gives an empty table; no training text gives the uniform model; other columns are not read.
"""

from __future__ import annotations

import math
import os
import tempfile
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb
from .store import new_path, stash

FOLDS, HELD_OUT = 7, 2
#: Hashes of the begin and the end of a text; no word has them but by chance.
BEGIN, END = np.uint64(0x0B5E55ED0DDBA115), np.uint64(0xE4DE4DE4DE4DE4D1)
#: Bytes of training text for each range of contexts, and pairs that a task holds before it sends them.
RANGE_BYTES, HOLD = 8 << 20, 1 << 21


def token_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the end of each text, and each row's first token (length rows + 1)."""
    buf = tb.LOWER[buf]
    s, e, first = tb.word_bounds(buf, offs)
    h = tb.PrefixHash(buf).of(s, e)
    rows = len(offs) - 1
    start = first + np.arange(rows + 1)
    out = np.empty(len(h) + rows, np.uint64)
    out[start[1:] - 1] = END
    inside = np.ones(len(out), bool)
    inside[start[1:] - 1] = False
    out[inside] = h
    return out, start


def contexts_of(tokens: np.ndarray, start: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[start[:-1]] = BEGIN
    return before


def add_up(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums of values by the distinct tuples of keys, sorted."""
    if not len(keys[0]):
        return keys, values
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) for v in values]


def _pack(*arrays: np.ndarray) -> bytes:
    return zlib.compress(b"".join(a.tobytes() for a in arrays), 1)


def _range(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


_PART = "range int, rows int, part binary"


def _parts(h: np.ndarray, bits: int, arrays: list[np.ndarray]) -> Iterator[tuple]:
    """One packed row for each range that occurs; h is sorted."""
    if not len(h):
        return
    r = _range(h, bits)
    cut = np.flatnonzero(np.diff(r)) + 1
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(h)], strict=True):
        yield int(r[a]), b - a, _pack(*(x[a:b] for x in arrays))


def _part_batch(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["range", "rows", "part"])


def _count_pairs(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush():
            if held:
                (u, w), (c,) = add_up([np.concatenate(x) for x in zip(*held, strict=True)], [np.ones(sum(len(x[0]) for x in held), np.uint32)])
                held.clear()
                out = list(_parts(u, bits, [u, w, c.astype(np.uint32)]))
                for k in range(0, len(out), 64):
                    yield _part_batch(out[k : k + 64])

        n = 0
        for batch in batches:
            for _lo, _hi, buf, offs in tb.slices(batch.column(0)):
                w, start = token_hashes(buf, offs)
                held.append((contexts_of(w, start), w))
                n += len(w)
                if n >= HOLD:
                    yield from flush()
                    n = 0
        yield from flush()

    return run


def _unpack(table: pa.Table, kinds: list) -> list[np.ndarray]:
    cols: list[list] = [[] for _ in kinds]
    for n, part in zip(table.column("rows").to_pylist(), table.column("part").to_pylist(), strict=True):
        raw, at = zlib.decompress(part), 0
        for col, kind in zip(cols, kinds, strict=True):
            size = n * np.dtype(kind).itemsize
            col.append(np.frombuffer(raw[at : at + size], kind))
            at += size
    return [np.concatenate(c) for c in cols]


# --- files in the shared folder
def _local(path: str) -> str | None:
    u = urlparse(path)
    return u.path if u.scheme in ("", "file") else None


def save(path: str, array: np.ndarray) -> None:
    """Written under another name and then moved, so that a task that runs twice leaves one whole file."""
    at = _local(path)
    if at:
        os.makedirs(os.path.dirname(at), exist_ok=True)
        tmp = f"{at}.{os.getpid()}.{os.urandom(4).hex()}"
        array.tofile(tmp)
        os.replace(tmp, at)
    else:
        from pyarrow import fs

        system, where = fs.FileSystem.from_uri(path)
        system.create_dir(os.path.dirname(where), recursive=True)
        tmp = f"{where}.{os.urandom(8).hex()}"
        with system.open_output_stream(tmp) as f:
            f.write(array.tobytes())
        system.move(tmp, where)


#: Maps that a worker keeps open (each holds a file descriptor); of more, the one not used for longest is closed.
MAPS = 240
_maps: OrderedDict[str, np.ndarray] = OrderedDict()


def mapped(path: str, kind) -> np.ndarray:
    """The array, mapped into memory; from a store that can't be mapped it is fetched once into a file that has no name any more and ends with the worker."""
    if path not in _maps:
        at = _local(path)
        if at is None:
            from pyarrow import fs

            system, where = fs.FileSystem.from_uri(path)
            with system.open_input_stream(where) as f, tempfile.TemporaryFile() as own:
                while block := f.read(1 << 20):
                    own.write(block)
                own.flush()
                _maps[path] = np.memmap(own, kind, "r") if own.tell() else np.zeros(0, kind)
        elif not os.path.exists(at) or not os.path.getsize(at):
            _maps[path] = np.zeros(0, kind)
        else:
            _maps[path] = np.memmap(at, kind, "r")
        while len(_maps) > MAPS:
            _maps.popitem(last=False)
    _maps.move_to_end(path)
    return _maps[path]


def discounts(n: list[int]) -> list[float]:
    """D1, D2 and D3+ from the numbers of things seen once, twice, three and four times; where these are lacking, fixed ones."""
    if min(n) <= 0:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max((k + 1) - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]


_STAT = "range int, rows int, part binary, n1 long, n2 long, n3 long, n4 long, pairs long"


def _of_four(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _stat_table(out: list[tuple], n: list[int], total: int) -> pa.Table:
    out = [*[(*o, 0, 0, 0, 0, 0) for o in out], (None, 0, None, *n, total)]
    kinds = [pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 5]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _STAT.split(", ")])


def _merge_pairs(bits: int, path: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Writes the range's contexts and pairs with their counts, and sends on in how many contexts, and how often, each word occurs."""
        u, w, c = _unpack(table, [np.uint64, np.uint64, np.uint32])
        (u, w), (c,) = add_up([u, w], [c.astype(np.int64)])
        r = key[0].as_py()
        own = tb.mix(u * np.uint64(3) ^ w)
        order = np.argsort(own, kind="stable")
        save(f"{path}/pair-{r}", own[order])
        save(f"{path}/pair-count-{r}", c[order].astype(np.uint64))
        at = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        save(f"{path}/context-{r}", u[at])
        save(f"{path}/context-sums-{r}", np.stack([np.add.reduceat(c, at), *(np.add.reduceat(((c == k) if k < 3 else (c >= 3)).astype(np.int64), at) for k in (1, 2, 3))], axis=1))
        (words,), (kinds, total) = add_up([w], [np.ones(len(w), np.int64), c])
        return _stat_table(list(_parts(words, bits, [words, kinds, total])), _of_four(c), len(c))

    return run


def _merge_words(path: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        w, kinds, total = _unpack(table, [np.uint64, np.int64, np.int64])
        (w,), (kinds, total) = add_up([w], [kinds, total])
        r = key[0].as_py()
        save(f"{path}/word-{r}", w)
        save(f"{path}/word-sums-{r}", np.stack([kinds, total], axis=1))
        return _stat_table([], _of_four(kinds), len(w)).append_column("tokens", pa.array([int(total.sum())], pa.int64())).append_column("kinds", pa.array([int(kinds.sum())], pa.int64())).append_column("seen3", pa.array([int((kinds >= 3).sum())], pa.int64()))

    return run


def fit(texts: DataFrame) -> dict:
    """Counts the one text column of texts; returns the model: a folder in the shared store and a few sums."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / RANGE_BYTES))))
    path = new_path(spark, "model")
    pairs = texts.mapInArrow(_count_pairs(bits), _PART)
    words = stash(pairs.groupBy("range").applyInArrow(_merge_pairs(bits, path), _STAT), "words")
    sums = words.filter("range IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n1", "n2", "n3", "n4", "pairs")]).first()
    total = words.filter("range IS NOT NULL").select("range", "rows", "part").groupBy("range").applyInArrow(_merge_words(path), _STAT + ", tokens long, kinds long, seen3 long")
    t = total.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n1", "n2", "n3", "n4", "pairs", "tokens", "kinds", "seen3")]).first()
    return {
        "path": path,
        "bits": bits,
        "pair_discounts": discounts([sums[f"n{k}"] for k in (1, 2, 3, 4)]),
        "word_discounts": discounts([t[f"n{k}"] for k in (1, 2, 3, 4)]),
        "vocabulary": t["pairs"],
        "tokens": t["tokens"],
        "kinds": t["kinds"],
        "by_kinds": [t["n1"], t["n2"], t["seen3"]],
    }


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted in the sorted keys, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Scorer:
    def __init__(self, model: dict):
        self.m = model
        d = model["word_discounts"]
        self.rest = sum(a * b for a, b in zip(d, model["by_kinds"], strict=True)) / model["kinds"] if model["kinds"] else 1.0
        self.uniform = 1.0 / (model["vocabulary"] + 1)

    def _ranges(self, h: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        r = _range(h, self.m["bits"])
        order = np.argsort(r, kind="stable")
        cut = np.flatnonzero(np.diff(r[order])) + 1
        for part in np.split(order, cut):
            if len(part):
                yield int(r[part[0]]), part

    def words(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share by contexts, and count in training, of distinct words."""
        p, c = np.full(len(w), self.rest * self.uniform), np.zeros(len(w), np.int64)
        d = np.array([0.0, *self.m["word_discounts"]])
        for r, part in self._ranges(w):
            at, there = _find(mapped(f"{self.m['path']}/word-{r}", np.uint64), w[part])
            part, at = part[there], at[there]
            if len(part):
                sums = mapped(f"{self.m['path']}/word-sums-{r}", np.int64).reshape(-1, 2)[at]
                p[part] += (sums[:, 0] - d[np.minimum(sums[:, 0], 3)]) / self.m["kinds"]
                c[part] = sums[:, 1]
        return p, c

    def pairs(self, u: np.ndarray, w: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probability of distinct pairs (context, word), from the word's share."""
        p = lower.copy()
        d = np.array([0.0, *self.m["pair_discounts"]])
        for r, part in self._ranges(u):
            at, there = _find(mapped(f"{self.m['path']}/context-{r}", np.uint64), u[part])
            part, at = part[there], at[there]
            if not len(part):
                continue
            sums = mapped(f"{self.m['path']}/context-sums-{r}", np.int64).reshape(-1, 4)[at].astype(np.float64)
            own = (sums[:, 1:] @ d[1:]) / sums[:, 0] * lower[part]
            at, there = _find(mapped(f"{self.m['path']}/pair-{r}", np.uint64), tb.mix(u[part] * np.uint64(3) ^ w[part]))
            c = np.where(there, mapped(f"{self.m['path']}/pair-count-{r}", np.uint64)[at], 0).astype(np.int64)
            p[part] = own + np.where(there, (c - d[np.minimum(c, 3)]) / sums[:, 0], 0.0)
        return p


_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double"


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        floor = math.log10(model["tokens"] + model["vocabulary"] + 1)  # one more for each word and for an unknown one
        for batch in batches:
            for lo, hi, buf, offs in tb.slices(batch.column(1), 4 << 20):
                w, start = token_hashes(buf, offs)
                words, back = np.unique(w, return_inverse=True)
                lower, count = scorer.words(words)
                u = contexts_of(w, start)
                own = tb.mix(u * np.uint64(3) ^ w)
                _, one, pair_back = np.unique(own, return_index=True, return_inverse=True)
                p = scorer.pairs(u[one], w[one], lower[back[one]])
                at = start[:-1]
                cols = [
                    batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                    pa.array(np.diff(start)),
                    pa.array(np.add.reduceat((count[back] > 0).astype(np.int64), at)),
                    pa.array(np.add.reduceat(np.log10(count[back] + 1.0), at) - np.diff(start) * floor),
                    pa.array(total := np.add.reduceat(np.log10(p)[pair_back], at)),
                    pa.array(10.0 ** (-total / np.diff(start))),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in _SCORES.split(", ")])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def score(docs: DataFrame, model: dict, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, n_tokens, n_known, base_score, score (log10 probability), perplexity (by token). No shuffle."""
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(_score(model), _SCORES)


def op7_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(~held_out(F.col("doc_id"))).select("text"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
