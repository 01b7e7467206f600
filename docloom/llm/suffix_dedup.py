"""Substring dedup by suffix arrays: bytes covered by a string of LENGTH bytes that also starts anywhere else go.

Two equal strings of LENGTH bytes have their least-hashed GRAM at the same place. So each string is known by that anchor, neighbouring strings that share it
make one context, and only contexts whose anchor occurs again are looked at: a first pass counts anchors, the second sends only contexts of those. Contexts that
are equal throughout (by 128-bit digest) count as one that repeats. The distinct contexts of an anchor are sorted together, by two-stage suffix
sorting: suffixes smaller than their successors are sorted directly, all others are induced from them in one scan over buckets; adjacent common prefixes
of LENGTH bytes then mark the strings that occur again.

Defined cases: null and empty texts have no strings, nor have texts under LENGTH bytes; texts may be of any length; rows of one id (or of null) are told apart
by their texts, and equal rows repeat each other; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb
from .bits import Bits, bit_table
from .store import stash

LENGTH, GRAM = 200, 48
#: Bytes of text whose contexts are sorted in one suffix array, and of one look for anchors.
SORT_BYTES, PIECE = 1 << 20, 1 << 22
#: An anchor with more distinct contexts is dealt out by narrower contexts, of BLOCK strings, keyed by all that these have in common.
HOT, BLOCK = 5000, 8
_POS = 24


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    m, size = v, 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(v) - w + 1], m[w - size :]) if size < w else m


def anchor_runs(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """For runs of neighbouring strings with one anchor: row, first start, number of starts, anchor's place (in the buffer), hash of the anchor."""
    none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    if len(buf) < length:
        return none
    prefix = tb.PrefixHash(buf)
    at = np.arange(len(buf) - gram + 1)
    h = prefix.of(at, at + gram)
    packed = (h >> np.uint64(_POS) << np.uint64(_POS)) | at.astype(np.uint64)
    anchor = (sliding_min(packed, length - gram + 1) & np.uint64((1 << _POS) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(anchor)]
    s = np.flatnonzero(np.arange(len(anchor)) + length <= offs[row + 1])
    if not len(s):
        return none
    new = np.ones(len(s), bool)
    new[1:] = (np.diff(anchor[s]) != 0) | (np.diff(s) != 1) | (np.diff(row[s]) != 0)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(s)))
    lo = s[first]
    a = anchor[lo]
    return row[lo], lo, n, a, h[a]


def _pieces(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, place of the piece in it, bytes, offsets); a text beyond PIECE comes in pieces that overlap by what a string needs."""
    for lo, _hi, buf, offs in tb.slices(col):
        if len(buf) <= PIECE:
            yield lo, 0, buf, offs
        else:
            for p in range(0, len(buf), PIECE):
                part = buf[p : p + PIECE + LENGTH - 1]
                yield lo, p, part, np.array([0, len(part)])


def _anchor_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _lo, _at, buf, offs in _pieces(batch.column(0)):
            key, n = np.unique(anchor_runs(buf, offs)[4].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["ah", "n"])


_ROWS = "ah long, c1 long, c2 long, doc long, own long, lo long, n int, off int"


def _anchor_rows(size: int, packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = Bits.unpack(size, packed)
        for batch in batches:
            for lo, at, buf, offs in _pieces(batch.column(2)):
                runs = anchor_runs(buf, offs)
                row, s, n, a, ah = (x[np.flatnonzero(again.has(runs[4]))] for x in runs)
                raw = buf.tobytes()
                each = zip(s.tolist(), (s + n - 1 + LENGTH).tolist(), (a - s).tolist(), strict=True)
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[x:y], k) for x, y, k in each), np.int64).reshape(-1, 2)
                ids = [batch.column(k).take(pa.array(lo + row)) for k in (0, 1)]
                cols = [ah.view(np.int64), digest[:, 0], digest[:, 1], *ids, s - offs[row] + at, n.astype(np.int32), (a - s).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=[x.split()[0] for x in _ROWS.split(", ")])

    return run


# --- two-stage suffix sorting
def _words(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as one number (most significant first)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = padded[: len(text)].copy()
    for k in range(1, 8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def sort_directly(words: np.ndarray, at: np.ndarray, depth: int, prefix: tb.PrefixHash | None = None) -> np.ndarray:
    """The suffixes at, sorted by their first depth bytes: by eight bytes, then each group of ties by the next eight. Groups that are equal to the end, as copies are, need no more rounds."""
    n = len(words)
    order = at[np.argsort(words[at], kind="stable")]
    key = words[order]
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(order) else order
    equal = np.zeros(len(order), bool)  # in a group of which all members have the same depth bytes
    for d in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero((size[group] > 1) & ~equal)
        if prefix and len(tied) and d in (8, 32, 96):
            h = prefix.of(order[tied], np.minimum(order[tied] + depth, n))
            first = np.flatnonzero(np.concatenate([[True], np.diff(group[tied]) != 0]))
            same = np.minimum.reduceat(h, first) == np.maximum.reduceat(h, first)
            equal[tied] = np.repeat(same, np.diff(np.append(first, len(tied))))
            tied = tied[~equal[tied]]
        if not len(tied):
            break
        sub, g = order[tied], group[tied]
        place = sub + d
        key = np.where(place < n, words[np.minimum(place, n - 1)], 0)
        o = np.lexsort((key, g))
        order[tied] = sub[o]
        key, g = key[o], g[o]
        split = np.zeros(len(order), bool)
        split[tied[1:]] = (key[1:] != key[:-1]) & (g[1:] == g[:-1])
        fresh = np.concatenate([[False], group[1:] != group[:-1]])
        group = np.cumsum(fresh | split)
    return order


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of text (which ends with 0) in the order of their first depth bytes."""
    n = len(text)
    # smaller than its successor: the next unequal byte is larger; the end is smaller than all
    differs = np.flatnonzero(np.concatenate([text[1:] != text[:-1], [True]]))
    nxt = differs[np.searchsorted(differs, np.arange(n))]
    small = np.where(nxt + 1 < n, text[nxt] < text[np.minimum(nxt + 1, n - 1)], True)
    words = _words(text)
    direct = sort_directly(words, np.flatnonzero(small), depth, tb.PrefixHash(text))
    ends = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def tell(placed: np.ndarray, c: int) -> np.ndarray:
        """Hands the predecessors of placed suffixes to their buckets; returns those of bucket c itself."""
        before = placed[placed > 0] - 1
        before = before[~small[before]]
        d = text[before]
        own = before[d == c]
        rest = before[d != c]
        if len(rest):
            d = d[d != c]
            o = np.argsort(d, kind="stable")
            rest, d = rest[o], d[o]
            cut = np.flatnonzero(np.diff(d)) + 1
            for x, e in zip(np.split(rest, cut), d[np.concatenate([[0], cut])].tolist(), strict=True):
                waiting[e].append(x)
        return own

    for c in range(256):
        found = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(found):
            out.append(found)
            found = tell(found, c)
        direct_c = direct[ends[c] : ends[c + 1]]
        if len(direct_c):
            out.append(direct_c)
            tell(direct_c, c)
    return np.concatenate(out)


def repeated_starts(contexts: list[bytes], starts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its first starts[i] places begin a string of length bytes that begins elsewhere, too."""
    sizes = np.array([len(c) + 1 for c in contexts])
    first = np.concatenate([[0], np.cumsum(sizes)])
    text = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8) + np.uint8(1)  # 0xff is not in UTF-8; it becomes the 0 that ends each
    sa = suffix_array(text, length)
    own = np.repeat(np.arange(len(contexts)), sizes)
    sa = sa[(sa - first[own[sa]]) < np.array(starts)[own[sa]]]
    words = _words(text)
    a, b = sa[:-1], sa[1:]
    same = np.arange(len(a))
    for d in range(0, length, 8):  # adjacent common prefixes, as far as length
        shift = np.uint64(8 * max(0, 8 - (length - d)))
        same = same[words[a[same] + d] >> shift == words[b[same] + d] >> shift]
    hit = np.zeros(len(text), bool)
    hit[a[same]] = hit[b[same]] = True
    return [hit[f : f + n] for f, n in zip(first[:-1].tolist(), starts, strict=True)]


def _ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


_CONTEXTS = "key long, ah long, c1 long, c2 long, shift int, n int, context binary"


def _contexts(hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts the wanted contexts out of the texts; those of hot anchors in blocks of starts, by their distance from the anchor."""
        names = [x.split()[0] for x in _CONTEXTS.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for raw, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in wanted:
                    lo, n, a = w["lo"], w["n"], w["lo"] + w["off"]
                    if w["k"] <= hot:
                        out.append((w["ah"], w["ah"], w["c1"], w["c2"], 0, n, raw[lo : lo + n - 1 + LENGTH]))
                        continue
                    for block in range((a - lo - n + 1) // BLOCK, (a - lo) // BLOCK + 1):
                        s, e = max(lo, a - BLOCK * block - BLOCK + 1), min(lo + n, a - BLOCK * block + 1)
                        core = raw[a - BLOCK * block : a - BLOCK * block - BLOCK + 1 + LENGTH]
                        key = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=block.to_bytes(8, "big")).digest(), "big", signed=True)
                        out.append((key, w["ah"], w["c1"], w["c2"], s - lo, e - s, raw[s : e - 1 + LENGTH]))
                    if len(out) > 20000:
                        yield _context_batch(out, names)
                        out = []
            yield _context_batch(out, names)

    return run


def _context_batch(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [[]] * 7
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts come sorted by key; whole keys are gathered up to SORT_BYTES and sorted in one suffix array."""
    held: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        out = []
        for (_, ah, c1, c2, shift, n, _), hit in zip(held, repeated_starts([x[6] for x in held], [x[5] for x in held]), strict=True):
            out.extend((ah, c1, c2, shift + a, shift + b) for a, b in _ranges(hit))
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [*[pa.int64()] * 3, pa.int32(), pa.int32()], strict=True)], names=["ah", "c1", "c2", "a", "b"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= SORT_BYTES and row[0] != held[-1][0]:
                yield done()
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield done()


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc, own (a hash of the text, that tells rows of one id apart), text."""
    t = F.col(f"`{text}`").cast("string")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(t).alias("own"), t.alias("text"))


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hot: int = HOT) -> DataFrame:
    """(doc, own, starts: array of (s, e)): ranges of places where strings start that also start elsewhere."""
    spark = docs.sparkSession
    texts = _texts(docs, text, doc_id)
    keys = texts.select("text").mapInArrow(_anchor_keys, "ah long, n long").groupBy("ah").agg(F.sum("n").alias("n")).filter("n > 1").select("ah")
    keys = stash(keys, "anchor-keys")
    rows = stash(texts.mapInArrow(_anchor_rows(*bit_table(keys, keys.count())), _ROWS), "anchors")
    # equal contexts are one, known by its first document
    place = F.struct("doc", "own", "lo", "n", "off")
    distinct = stash(rows.groupBy("ah", "c1", "c2").agg(F.count(F.lit(1)).alias("k"), F.min(place).alias("x")), "contexts")
    kinds = distinct.groupBy("ah").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = distinct.join(kinds, "ah").select("ah", "c1", "c2", F.col("kinds").alias("k"), "x.*")
    by_doc = wanted.groupBy("doc", "own").agg(F.collect_list(F.struct("ah", "c1", "c2", "lo", "n", "off", "k")).alias("wanted"))
    own = texts.select(F.col("doc").alias("d"), F.col("own").alias("o"), F.encode("text", "utf-8").alias("raw"))
    cut = by_doc.join(own, F.col("doc").eqNullSafe(F.col("d")) & (F.col("own") == F.col("o"))).select("raw", "wanted").mapInArrow(_contexts(hot), _CONTEXTS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = cut.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_sort, "ah long, c1 long, c2 long, a int, b int")
    hits = found.unionByName(distinct.filter("k > 1").select("ah", "c1", "c2", F.lit(0).alias("a"), F.col("x.n").alias("b")))
    places = rows.select("ah", "c1", "c2", "doc", "own", "lo").join(hits, ["ah", "c1", "c2"]).select("doc", "own", (F.col("lo") + F.col("a")).alias("s"), (F.col("lo") + F.col("b")).alias("e"))
    return places.groupBy("doc", "own").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("starts"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of starts to spans of bytes."""
    for batch in batches:
        out = []
        for starts in batch.column(2).to_pylist():
            spans: list[list[int]] = []
            for x in starts:
                s, e = x["s"], x["e"] - 1 + LENGTH
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            out.append(([s for s, _ in spans], [e for _, e in spans]))
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in out], kind), pa.array([x for _, x in out], kind)], names=["doc", "own", "span_starts", "span_ends"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, raw, starts, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw, starts, ends = raw or b"", starts or [], ends or []
            digest, at = hashlib.sha256(), 0
            for s, e in zip(starts, ends, strict=True):
                digest.update(raw[at:s])
                at = e
            digest.update(raw[at:])
            out.append((doc, len(raw), sum(ends) - sum(starts), len(starts), digest.hexdigest(), starts, ends))
        cols = list(zip(*out, strict=True)) if out else [[]] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends"])


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hot: int = HOT) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends (bytes). Spans are joined by id and text: their number grows with the input."""
    found = repeated(docs, text, doc_id, hot).mapInArrow(_merge, "doc long, own long, span_starts array<long>, span_ends array<long>")
    texts = _texts(docs, text, doc_id).select(F.col("doc").alias("doc_id"), F.col("own").alias("o"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("o") == F.col("own"))
    joined = texts.join(found.hint("merge"), same, "left").select("doc_id", F.encode("text", "utf-8").alias("raw"), "span_starts", "span_ends")
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>")


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
