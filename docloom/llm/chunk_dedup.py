"""Substring dedup by content-defined chunking.

A gear hash rolls over each text; where its top bits are zero a chunk ends, so cuts depend on the last 32 bytes only and an insertion moves no cut beyond
them. Chunks are known by 128-bit digests; those found more than once count as repeated, and all but the first (by doc_id, then text, then place) go.
A lone short chunk that repeats, such as a phrase, is left: neighbouring repeated chunks must make up LEAST bytes, which is the length of a passage.

A first pass counts short keys of all chunks, one row for each key and task; in the second only chunks whose key occurs again are sent, with their digests.

Defined cases: null and empty texts have no chunks; texts may be of any length (a chunk has MOST bytes at most); cuts never split a character; rows of one id
(or of null, which comes first) are told apart by their texts, and equal rows are one document; ties go to the smaller place; an empty table gives an empty
table; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import textbuf as tb
from .bits import Bits, bit_table
from .store import stash

#: A cut in 16 bytes, not within 16 bytes after a place that could be one: 45 bytes a chunk.
ZERO_BITS, CALM, MOST = 4, 16, 1024
LEAST = 100
_WINDOW = 32


def _gear() -> np.ndarray:
    return (tb.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def gear_hashes(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """h[i] = (h[i - 1] << 1) + gear[byte i], started anew in each row. A byte is shifted out after 32 steps, so five doublings give all sums."""
    rows = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    at = np.arange(len(buf)) + _WINDOW * (rows + 1)
    h = np.zeros(len(buf) + _WINDOW * (len(offs)), np.uint32)
    h[at] = GEAR[buf]
    step = 1
    while step < _WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h[at]


def chunks(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all rows."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    could = np.flatnonzero(gear_hashes(buf, offs) >> np.uint32(32 - ZERO_BITS) == 0) + 1
    row = np.searchsorted(offs, could - 1, "right")
    calm = np.ones(len(could), bool)
    calm[1:] = (np.diff(could) >= CALM) | (np.diff(row) > 0)
    cuts = could[calm]
    whole = np.append(buf & 0xC0 != 0x80, True)
    for _ in range(3):
        cuts = cuts + ~whole[cuts]
    cuts = np.unique(np.concatenate([cuts, offs]))
    gaps = np.diff(cuts)
    long = np.flatnonzero(gaps > MOST)
    if len(long):
        more = np.concatenate([np.arange(cuts[k] + MOST, cuts[k + 1], MOST) for k in long])
        for _ in range(3):
            more = more + ~whole[more]
        cuts = np.unique(np.concatenate([cuts, more]))
    return cuts[:-1], cuts[1:]


def _chunk_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _lo, _hi, buf, offs in tb.slices(batch.column(0)):
            key, n = np.unique(tb.PrefixHash(buf).of(*chunks(buf, offs)).view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])


_CHUNKS = "d1 long, d2 long, doc long, own long, pos int, len int"


def _chunk_rows(size: int, packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Bits.unpack(size, packed)
        for batch in batches:
            for lo, _hi, buf, offs in tb.slices(batch.column(2)):
                s, e = chunks(buf, offs)
                at = np.flatnonzero(again.has(tb.PrefixHash(buf).of(s, e)))
                s, e = s[at], e[at]
                raw = buf.tobytes()
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(s.tolist(), e.tolist(), strict=True)), np.int64).reshape(-1, 2)
                row = np.searchsorted(offs, s, "right") - 1
                ids = [batch.column(k).take(pa.array(lo + row)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(digest[:, 0]), pa.array(digest[:, 1]), *ids, pa.array((s - offs[row]).astype(np.int32)), pa.array((e - s).astype(np.int32))], names=[x.split()[0] for x in _CHUNKS.split(", ")])

    return run


_REPEATS = "doc long, own long, repeated long, removed long, starts array<long>, ends array<long>"


def _runs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, own, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs: list[list] = []
                for pos, n, again in sorted({(x["pos"], x["len"], x["again"]) for x in found}):
                    if runs and runs[-1][-1][0] + runs[-1][-1][1] == pos:
                        runs[-1].append((pos, n, again))
                    else:
                        runs.append([(pos, n, again)])
                runs = [r for r in runs if sum(x[1] for x in r) >= least]
                spans: list[list[int]] = []
                for pos, n, again in (x for r in runs for x in r):
                    if again and spans and spans[-1][1] == pos:
                        spans[-1][1] = pos + n
                    elif again:
                        spans.append([pos, pos + n])
                if runs:
                    out.append((doc, own, sum(x[1] for r in runs for x in r), sum(b - a for a, b in spans), [a for a, _ in spans], [b for _, b in spans]))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _REPEATS.split(", ")])

    return run


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc, own (a hash of the text, that tells rows of one id apart), text."""
    t = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(t).alias("own"), t.alias("text"))


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST) -> DataFrame:
    """(doc, own, repeated, removed, starts, ends) of documents that hold repeated chunks: bytes repeated, bytes that go, and where.

    Digests are counted before they are shuffled; the join of a hot one with its single first place is split by AQE like any skewed join.
    """
    texts = _texts(docs, text, doc_id)
    keys = texts.select("text").mapInArrow(_chunk_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    keys = stash(keys, "chunk-keys")
    rows = stash(texts.mapInArrow(_chunk_rows(*bit_table(keys, keys.count())), _CHUNKS), "chunks")
    place = F.struct("doc", "own", "pos")
    many = rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    found = rows.join(many, ["d1", "d2"]).select("doc", "own", F.struct("pos", "len", (~place.eqNullSafe(F.col("first"))).alias("again")).alias("x"))
    return found.groupBy("doc", "own").agg(F.collect_list("x").alias("found")).mapInArrow(_runs(least), _REPEATS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for t, starts, ends in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            if starts:
                raw, at, parts = t.encode(), 0, []
                for a, b in zip(starts, ends, strict=True):
                    parts.append(raw[at:a])
                    at = b
                t = b"".join([*parts, raw[at:]]).decode()
            texts.append(t)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "kept"])


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST) -> DataFrame:
    """docs with text cut."""
    spans = stash(repeats(docs, text, doc_id, least).filter("removed > 0").select("doc", "own", "starts", "ends"), "spans")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row")
    t = F.col(f"`{text}`").cast("string")
    whole = docs.select(rest, t.alias("text"), F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(t).alias("hash"))
    joined = whole.join(spans, F.col("id").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("own")), "left").select("row", "text", "starts", "ends")
    cut = joined.mapInArrow(_cut, StructType([joined.schema["row"], StructField("kept", StringType())]))
    return cut.select(*[(F.col("kept") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op1_chunk_dedup(spark, sf_dir: str) -> DataFrame:
    """Documents that hold repeated passages: how many bytes repeat, how many go, and where (start:end in bytes)."""
    found = repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.array_join(F.zip_with("starts", "ends", lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string"))), ",")
    return found.select(F.col("doc").alias("doc_id"), F.col("repeated").alias("n_repeated"), F.col("removed").alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), spans.alias("spans"))
