"""Benchmark decontamination by greedy string tiling.

Runs of five words are the seeds: those of the benchmark, spread over the cluster like any table, are joined with those of the documents. Only pairs of a text
and an item that share a seed are compared. Then the longest matches that do not overlap are marked again and again (running Karp-Rabin), down to
five words; an item of which the marked tiles cover enough is leaked, in whatever order its passages stand in the document.

Before the join a bit table of bounded size passes over windows of documents that are no seed for sure, equal texts become one, and each item leaves out its
most frequent seeds as far as these alone could not cover enough of it: a text that holds the item has one of the others, too.

Defined cases: null and empty texts and those under five words match nothing, nor do such items; letter case A-Z is ignored; texts may be of any length;
repeated rows are each judged, and repeated items each reported; ties between equally long matches go to the first in the document, then in the item;
empty tables match nothing; other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb
from .bits import Bits, bit_table
from .store import small_batches, stash

SEED = 5
COVER = 0.5
BROADCAST_TEXTS = 1_000_000


def tile(doc: list[int], item: list[int], least: int = SEED, first: int = 20) -> list[tuple[int, int, int]]:
    """Tiles (start in doc, start in item, length), by running Karp-Rabin greedy string tiling. Negative words match nothing."""
    in_doc, in_item, tiles = [w < 0 for w in doc], [w < 0 for w in item], []
    s = max(least, min(first, len(item)))
    mod, base = (1 << 61) - 1, 1_000_003

    def hashes(words: list[int], marked: list[bool]) -> Iterator[tuple[int, int]]:
        """(start, rolling hash) of each window of s unmarked words."""
        top, h, n = pow(base, s - 1, mod), 0, 0
        for i, w in enumerate(words):
            if marked[i]:
                h = n = 0
                continue
            if n >= s:
                h = (h - words[i - s] * top) % mod
            h = (h * base + w) % mod
            n += 1
            if n >= s:
                yield i - s + 1, h

    def free(i: int, j: int) -> bool:
        return not in_doc[i] and not in_item[j]

    while True:
        table: dict[int, list[int]] = {}
        for j, h in hashes(item, in_item):
            table.setdefault(h, []).append(j)
        queue, longest = [], 0
        for i, h in hashes(doc, in_doc):
            for j in table.get(h, ()):
                if i and j and doc[i - 1] == item[j - 1] and free(i - 1, j - 1):
                    continue  # part of the match that starts before
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and free(i + k, j + k):
                    k += 1
                if k >= s:
                    queue.append((-k, i, j))
                    longest = max(longest, k)
        if longest > 2 * s:
            s = longest
            continue
        heapq.heapify(queue)
        while queue:
            k, i, j = heapq.heappop(queue)
            k = -k
            # what longer tiles have left of the match; each part goes back into the queue, so that no match of s words remains at the end
            parts, n = [], 0
            while n < k:
                begin = n
                while n < k and free(i + n, j + n):
                    n += 1
                if n - begin >= s:
                    parts.append((begin - n, i + begin, j + begin))
                n += 1
            if parts == [(-k, i, j)]:
                in_doc[i : i + k] = [True] * k
                in_item[j : j + k] = [True] * k
                tiles.append((i, j, k))
            else:
                for part in parts:
                    heapq.heappush(queue, part)
        if s == least:
            return tiles
        s = max(least, s // 2)


# --- seeds
def _windows(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, each row's first word, and the hashes and rows of the windows of SEED words within rows (by their first word)."""
    buf = tb.LOWER[buf]
    s, e, first = tb.word_bounds(buf, offs)
    h = tb.PrefixHash(buf).of(s, e)
    w = tb.window_hash(h, SEED)
    row = np.searchsorted(first, np.arange(len(w)), "right") - 1
    return h, first, w, np.where(np.arange(len(w)) + SEED <= first[row + 1], row, -1)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), kind))


_ITEMS = "item_id long, item string, words array<long>, seeds array<long>"
_SEEDED = "doc_id long, digest string, words array<long>, places array<int>, seeds array<long>"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of SEED words or more, known by the digest of their text, with the hashes of their words and windows."""
    for batch in batches:
        for lo, _hi, buf, offs in tb.slices(batch.column(1)):
            h, first, w, row = _windows(buf, offs)
            rows = np.flatnonzero(np.diff(first) >= SEED)
            words = [h[first[r] : first[r + 1]].view(np.int64) for r in rows]
            seeds = [w[first[r] : first[r + 1] - SEED + 1].view(np.int64) for r in rows]
            digest = [hashlib.sha256(buf[offs[r] : offs[r + 1]]).hexdigest() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + rows)), pa.array(digest, pa.string()), _lists(words, pa.int64()), _lists(seeds, pa.int64())], names=["item_id", "item", "words", "seeds"])


def _seeded(size: int, packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with windows that may be seeds: these, and the words that they cover with their places."""
        bits = Bits.unpack(size, packed)
        for batch in batches:
            for lo, _hi, buf, offs in tb.slices(batch.column(1)):
                h, first, w, row = _windows(buf, offs)
                at = np.flatnonzero(bits.has(w) & (row >= 0))
                rows, words, places, seeds, digest = np.unique(row[at]), [], [], [], []
                cut = np.searchsorted(row[at], [*rows, len(offs)]).tolist()
                for r, a, b in zip(rows.tolist(), cut[:-1], cut[1:], strict=True):
                    covered = np.unique(at[a:b, None] + np.arange(SEED))
                    words.append(h[covered].view(np.int64))
                    places.append(covered - first[r])
                    seeds.append(np.unique(w[at[a:b]].view(np.int64)))
                    digest.append(hashlib.sha256(buf[offs[r] : offs[r + 1]]).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(lo + rows)), pa.array(digest, pa.string()), _lists(words, pa.int64()), _lists(places, pa.int32()), _lists(seeds, pa.int64())], names=["doc_id", "digest", "words", "places", "seeds"])

    return run


def _rarest(cover: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each item's seeds that occur in texts: without the most frequent ones as far as these cover too little of it; none where all of them do."""
        for batch in batches:
            items, seeds = [], []
            for item, n_words, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                covered: set[int] = set()
                for x in sorted(found, key=lambda x: (-x["n"], x["seed"], x["pos"])):
                    covered.update(range(x["pos"], x["pos"] + SEED))
                    if len(covered) >= cover * n_words:
                        items.append(item)
                        seeds.append(x["seed"])
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(seeds, pa.int64())], names=["item", "seed"])

    return run


def _tiled(cover: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, key, words, places, item = batch.columns
            out = []
            for d, k, w, p, x in zip(digest.to_pylist(), key.to_pylist(), words, places, item, strict=True):
                w, p, x = w.values.to_numpy(), p.values.to_numpy(), x.values.to_numpy()
                own = np.flatnonzero(np.isin(w, x))
                doc, at, before = [], [], -2
                for value, place in zip(w[own].view(np.uint64).tolist(), p[own].tolist(), strict=True):
                    if place != before + 1:  # words between can't take part
                        doc.append(-1)
                        at.append(-1)
                    doc.append(value)
                    at.append(place)
                    before = place
                tiles = tile(doc, x.view(np.uint64).tolist())
                share = sum(n for _, _, n in tiles) / len(x)
                if share >= cover:
                    out.append((d, k, share, ",".join(f"{at[i]}:{at[i] + n}" for i, _, n in sorted(tiles))))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.float64(), pa.string()), strict=True)], names=["digest", "item", "coverage", "spans"])

    return run


def _search(docs: DataFrame, benchmark: DataFrame, text: str, doc_id: str, cover: float) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest of the text) of documents with seeds, and (digest, found: [(item_id, coverage, spans)]) of contaminated texts."""
    small_batches(docs.sparkSession)
    items = stash(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_items, _ITEMS), "items")
    one = items.select("item", "words", "seeds").dropDuplicates(["item"])
    bits = bit_table(items.select("seeds"), items.agg(F.sum(F.size("seeds"))).first()[0] or 0)
    seeded = stash(docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(_seeded(*bits), _SEEDED), "seeded")
    texts = stash(seeded.groupBy("digest").agg(F.first(F.struct("words", "places", "seeds")).alias("x")).select("digest", "x.*"), "texts")
    holds = texts.select("digest", F.explode("seeds").alias("seed"))
    counts = holds.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    asked = one.select("item", F.size("words").alias("n_words"), F.posexplode("seeds").alias("pos", "seed")).join(counts, "seed")
    rare = asked.groupBy("item").agg(F.max("n_words").alias("n_words"), F.collect_list(F.struct("n", "seed", "pos")).alias("found")).mapInArrow(_rarest(cover), "item string, seed long")
    pairs = holds.join(rare, "seed").select("digest", "item").distinct()
    whole = pairs.join(texts.select("digest", "words", "places"), "digest").join(one.select("item", F.col("words").alias("own")), "item")
    found = whole.select("digest", "item", "words", "places", "own").mapInArrow(_tiled(cover), "digest string, item string, coverage double, spans string")
    named = found.join(items.select("item_id", "item"), "item").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("item_id", "coverage", "spans"))).alias("found"))
    return seeded.select("doc_id", "digest"), stash(named, "leaks")


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", cover: float = COVER) -> DataFrame:
    """(doc_id, found) for each contaminated document: its items as (item_id, coverage, spans: first:end words of the tiles)."""
    seeded, found = _search(docs, benchmark, text, doc_id, cover)
    return seeded.join(found, "digest").select("doc_id", "found")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", cover: float = COVER) -> DataFrame:
    """docs without the contaminated ones, which are known by their text."""
    _, found = _search(docs.select(F.lit(None).cast("long").alias("id"), F.col(f"`{text}`").alias("text")), benchmark, "text", "id", cover)
    gone = found.select("digest")
    if gone.count() <= BROADCAST_TEXTS:
        gone = F.broadcast(gone)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.sha2(F.col(f"`{text}`").cast("string"), 256).alias("own"))
    return whole.join(gone, F.col("own") == F.col("digest"), "left_anti").select("whole.*")


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    """The contaminated documents, with the items that leaked into them."""
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.col("found.item_id").alias("item_ids"), F.array_max("found.coverage").alias("coverage"), F.col("found.spans").alias("word_spans"), F.lit(True).alias("contaminated"))
