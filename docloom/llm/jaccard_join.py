"""Exact Jaccard self-join of documents on distinct five-word shingles, by set relations.

Index lists: each set's tokens are ordered rarest first, by a count sketch of fixed size taken over all documents; only the first n - ceil(0.8 n) + 1 are listed,
since two sets that link must share one of them. A list is cut into blocks by the size of the sets and by the token's position in them. A set probes only
the blocks in which some set could still reach the overlap it needs, from that size and that position on; all others are skipped unread.

Answers: in each list the set made of the most common tokens (a hub) is compared first. A set that links to a hub takes over the hub's answers, which are then
computed for all hubs, and is left with its own difference: by what its overlap with the hub leaves over, its overlap with any other set is bounded
by the overlap that the two hubs were found to have. Only pairs of different classes that pass that bound are compared.

Defined cases: null texts and texts without words have no shingles and link with nothing; texts under five words are one shingle; A-Z are lower-cased; texts
may be of any length; equal sets are one set, and repeated rows link with each other by doc_id; ties go to the smaller doc_id; an empty table gives an
empty table; a null doc_id links with nothing; other columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbuf as tb
from .components import components
from .store import small_batches, stash

SHINGLE = 5
#: Percent of the union that the intersection must reach.
SIMILARITY = 80
#: Counters of the sketch by which tokens are ordered, one byte each at the workers. Any order is exact; more counters keep lists shorter.
SLOT_BITS = 24
SLICES = 256
BROADCAST_IDS = 1_000_000


def shingle_sets(buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes."""
    buf = tb.LOWER[buf]
    s, e, first = tb.word_bounds(buf, offs)
    h = tb.PrefixHash(buf).of(s, e)
    w = tb.window_hash(h, SHINGLE)
    first = first.tolist()
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            yield np.unique(w[a : b - SHINGLE + 1])
        elif b > a:
            yield tb.mix(np.bitwise_xor.reduce(h[a:b] * (np.arange(b - a, dtype=np.uint64) * np.uint64(2) + np.uint64(0x5851F42D4C957F2D)), keepdims=True) + np.uint64(b - a))
        else:
            yield h[:0]


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


_SETS = "doc_id long, n int, s1 long, s2 long, slice int, counts binary"


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SLOT_BITS, np.uint8)  # a task's counts stop at 255: they only order tokens
    names = [x.split()[0] for x in _SETS.split(", ")]
    for batch in batches:
        ids, n, sig = batch.column(0), [], []
        for _lo, _hi, buf, offs in tb.slices(batch.column(1)):
            sets = list(shingle_sets(buf, offs))
            for x in sets:
                n.append(len(x))
                d = xxhash.xxh3_128_intdigest(x.tobytes())
                sig.append((d >> 64, d & (1 << 64) - 1))
            slots, more = np.unique(_slot(np.concatenate(sets)), return_counts=True)
            counts[slots] = np.minimum(counts[slots] + more, 255)
        s = np.array(sig, np.uint64).reshape(-1, 2).view(np.int64)
        nulls = pa.nulls(len(n))
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int32()), pa.array(s[:, 0]), pa.array(s[:, 1]), nulls.cast(pa.int32()), nulls.cast(pa.binary())], names=names)
    part = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SLICES)]
    none = pa.nulls(SLICES)
    yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(range(SLICES), pa.int32()), pa.array(part, pa.binary())], names=names)


def _levels(mean: float):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << SLOT_BITS) // SLICES, np.int64)
        for batch in batches:
            for x in batch.column(batch.schema.get_field_index("counts")):
                total += np.frombuffer(zlib.decompress(x.as_py()), np.uint8)
        above = np.floor(4 * np.log2(np.maximum(1.0, total / (mean + 4 * np.sqrt(mean))))).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(above.tobytes(), 1)], pa.binary())], names=["slice", "counts"])

    return run


def token_levels(sets: DataFrame) -> list[bytes]:
    """One byte a counter, packed: how far its count is above the mean, in quarters of powers of two; 2 ** SLOT_BITS bytes at most, whatever the input."""
    mean = max(1.0, (sets.agg(F.sum("n")).first()[0] or 0) / (1 << SLOT_BITS))
    parts = sets.filter("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(_levels(mean), "slice int, counts binary").collect()
    return [bytes(r["counts"]) for r in sorted(parts, key=lambda r: r["slice"])]


def _prefixes(levels: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(b"".join(map(zlib.decompress, levels)) or bytes(1 << SLOT_BITS), np.uint8)
        seen: set[bytes] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo, _hi, buf, offs in tb.slices(batch.column(1)):
                token, own, size, common, place = [], [], [], [], []
                for k, x in enumerate(shingle_sets(buf, offs)):
                    n = len(x)
                    if not n:
                        continue
                    key = xxhash.xxh3_128_digest(x.tobytes())
                    if key in seen:  # an equal set of this partition is listed already
                        continue
                    seen.add(key)
                    by = level[_slot(x)]
                    p = n - -(-SIMILARITY * n // 100) + 1
                    token.append(x[np.argsort(by, kind="stable")[:p]])  # x is sorted: by level, then hash
                    own.append(np.full(p, ids[lo + k], np.int64))
                    size.append(np.full(p, n, np.int32))
                    common.append(np.full(p, int(by.sum(dtype=np.int64) * 64 // n), np.int32))
                    place.append(np.arange(p, dtype=np.int32))
                if token:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(own)), pa.array(np.concatenate(size)), pa.array(np.concatenate(common)), pa.array(np.concatenate(place))], names=["token", "doc", "n", "pop", "pos"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, m, both = [], [], []
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = []
            for name in ("text_a", "text_b"):
                sets.append([x for _lo, _hi, buf, offs in tb.slices(part.column(part.schema.get_field_index(name))) for x in shingle_sets(buf, offs)])
            for x, y in zip(*sets, strict=True):
                n.append(len(x))
                m.append(len(y))
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int32()) for c in (n, m, both))], names=["a", "b", "n", "m", "both"])


def compared(pairs: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """(a, b, n, m, both) of candidate pairs (a, b): the sizes of their sets and of the intersection, by their whole texts."""
    pairs = stash(pairs, name + "-pairs")
    ids = pairs.select(F.col("a").alias("_v")).union(pairs.select("b")).distinct()
    ids = stash(ids, name + "-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_v"), "left_semi")
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return stash(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long, n int, m int, both int"), name + "-links")


def _need(n: str, m: str) -> str:
    """The intersection that sets of these sizes need."""
    return f"ceil({SIMILARITY} * ({n} + {m}) / {100 + SIMILARITY}.0)"


_LINK = f"both > 0 AND 100 * both >= {SIMILARITY} * (n + m - both)"
_NEED = _need("n", "m")
_SIZES = f"100 * least(n, m) >= {SIMILARITY} * greatest(n, m)"
#: What two sets share beyond their lists is at most the longer rest.
_SHARED = f"c + greatest(n - (n - ceil({SIMILARITY} * n / 100.0) + 1), m - (m - ceil({SIMILARITY} * m / 100.0) + 1)) >= {_NEED}"
#: Blocks: sizes by powers of RATIO, positions by powers of 4.
RATIO = 100 / SIMILARITY


def _size_block(n: str) -> str:
    return f"CAST(floor(ln({n}) / ln({RATIO})) AS INT)"


def _place_block(pos: str) -> str:
    return f"CAST(floor(log2({pos} + 1) / 2) AS INT)"


def probes(entries: DataFrame) -> DataFrame:
    """Each entry (token, n, pos ...) with the blocks (size, place) that it has to read: those of sets no larger than its own, where its position and theirs still allow the overlap."""
    sized = entries.withColumn("size", F.explode(F.expr(f"sequence({_size_block(f'ceil({SIMILARITY} * n / 100.0)')}, {_size_block('n')})")))
    edges = sized.withColumn("least_m", F.expr(f"greatest(ceil({SIMILARITY} * n / 100.0), floor(pow({RATIO}, size)) - 1)")).withColumn("most_m", F.expr(f"least(n, ceil(pow({RATIO}, size + 1)))"))
    limit = f"most_m - {_need('n', 'most_m')}"
    open_ = edges.filter(f"least_m <= most_m AND pos <= n - {_need('n', 'least_m')} AND {limit} >= 0")
    return open_.withColumn("place", F.explode(F.expr(f"sequence(0, {_place_block(limit)})"))).drop("least_m", "most_m")


def index(entries: DataFrame) -> DataFrame:
    """The entries that a set of the same size or a larger one may meet, with their block."""
    return entries.filter(f"pos <= n - {_need('n', 'n')}").withColumn("size", F.expr(_size_block("n"))).withColumn("place", F.expr(_place_block("pos")))


def candidates(entries: DataFrame, rows: DataFrame, which: str = "true") -> DataFrame:
    """(a, b, n, m) of pairs of different classes that may link, by the lists (token, doc, n, pos, most, class, hub)."""
    mixed = entries.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("token")
    left = entries.join(mixed, "token")
    right = index(left).select("token", "size", "place", *[F.col(c).alias(c + "2") for c in ("doc", "pos", "most", "class", "hub")], F.col("n").alias("m"))
    met = probes(left).join(right, ["token", "size", "place"]).filter("class <> class2 AND (n > m OR (n = m AND doc > doc2))").filter(which)
    # a listed token that no other set lists can't be shared with a set whose list ends later, though it may stand in the rest of one whose list ends
    # sooner: of two sets, the one whose list ends first shares at most its `most`
    met = met.filter(_SIZES).filter(f"greatest(most, most2) >= {_NEED} AND pos <= n - {_NEED} AND pos2 <= m - {_NEED}")
    pairs = met.select("doc", "doc2", "n", "m").distinct()
    listed_of = rows.groupBy(F.col("doc").alias("d")).agg(F.collect_list("token").alias("l"))  # at most a fifth of a set
    both = pairs.join(listed_of, F.col("doc") == F.col("d")).select("doc", "doc2", "n", "m", F.col("l").alias("l1")).join(listed_of, F.col("doc2") == F.col("d"))
    return both.withColumn("c", F.size(F.array_intersect("l1", "l"))).filter(_SHARED).select(F.col("doc").alias("a"), F.col("doc2").alias("b"), "n", "m")


def _sets_of(docs: DataFrame) -> DataFrame:
    return stash(docs.mapInArrow(_first_pass, _SETS), "sets")


def clashing(sets: DataFrame) -> bool:
    """Is there a doc_id on two rows, or a row without one?"""
    return bool(sets.filter("slice IS NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1 OR doc_id IS NULL").limit(1).count())


def numbered_classes(docs: DataFrame) -> DataFrame:
    """docs with a unique `row` and `text` -> (row, n, c): set size and class (the smallest row of it)."""
    by_row = docs.select(F.col("row").alias("doc_id"), "text")
    return _classes(by_row, _sets_of(by_row)).select(F.col("doc_id").alias("row"), F.col("n_shingles").alias("n"), F.col("component_id").alias("c"))


def jaccard_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = _sets_of(docs)
    if not clashing(sets):
        return _classes(docs, sets)
    rows = stash(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = stash(rows.select("row", "doc_id").join(numbered_classes(rows), "row"), "rows")
    names = found.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return found.join(names, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _classes(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """jaccard_classes of docs (doc_id, text) with a doc_id of its own on each row."""
    levels = token_levels(sets)
    sets = sets.filter("slice IS NULL").select("doc_id", "n", "s1", "s2")

    # equal sets
    firsts = sets.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    copies = sets.filter("n > 0").join(firsts, ["s1", "s2"]).select(F.col("doc_id").alias("a"), "b")

    # index lists of two sets or more, with the hub to compare first
    listed = docs.mapInArrow(_prefixes(levels), "token long, doc long, n int, pop int, pos int")
    lists = listed.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("pop", (-F.col("doc")).alias("d"), "n")).alias("top")).filter("k > 1")
    rows = stash(listed.join(lists.select("token", (-F.col("top.d")).alias("pivot"), F.col("top.n").alias("m")), "token").select("token", "doc", "n", "pos", "pivot", "m"), "lists")

    near = rows.filter("doc <> pivot").filter(_SIZES).groupBy("doc", "pivot", "n", "m").agg(F.count(F.lit(1)).alias("c")).filter(_SHARED)
    best = near.groupBy("doc").agg(F.max(F.struct("c", (-F.col("pivot")).alias("p"))).alias("x")).select(F.col("doc").alias("a"), (-F.col("x.p")).alias("b"))
    star = compared(best, docs, "first").filter(_LINK)
    classes = components(star.select("a", "b").union(copies))

    # each set's hub, and how many of its tokens the hub lacks; a set without a link to one is its own
    follows = star.groupBy("a").agg(F.first(F.struct("b", (F.col("n") - F.col("both")).alias("away"))).alias("x")).select("a", F.col("x.b").alias("of"), "x.away")
    hubs = star.select(F.col("b").alias("h")).distinct()
    most = rows.groupBy(F.col("doc").alias("d")).agg((F.max("n") - F.expr(f"max(n - ceil({SIMILARITY} * n / 100.0) + 1)") + F.count(F.lit(1))).cast("int").alias("most"), F.max("n").alias("size"))
    of_doc = most.join(follows, F.col("d") == F.col("a"), "left").join(hubs, F.col("d") == F.col("h"), "left")
    of_doc = stash(of_doc.select("d", "most", "size", F.when(F.col("h").isNotNull(), F.col("d")).otherwise(F.coalesce("of", "d")).alias("hub"), F.when(F.col("h").isNotNull(), 0).otherwise(F.coalesce("away", F.lit(0))).alias("away")), "hubs")

    def entries(found: DataFrame, which: str) -> DataFrame:
        one = of_doc.filter(which).join(found, F.col("d") == F.col("v"), "left").select("d", "most", "hub", F.coalesce("c", "d").alias("class"))
        return rows.select("token", "doc", "n", "pos").join(one, F.col("doc") == F.col("d")).select("token", "doc", "n", "pos", "most", "hub", "class")

    # the answers of all hubs
    answers = compared(candidates(stash(entries(classes, "hub = d"), "hub-lists"), rows).select("a", "b"), docs, "hub")
    classes = components(classes.select(F.col("v").alias("a"), F.col("c").alias("b")).union(answers.filter(_LINK).select("a", "b")))

    # what followers add to them: two hubs of different classes share what was found, or too little to link
    rest = candidates(stash(entries(classes, "true"), "classed"), rows, "doc <> hub OR doc2 <> hub2")
    side = lambda k: of_doc.select(F.col("d").alias(k), F.col("hub").alias("hub_" + k), F.col("away").alias("away_" + k))
    size = lambda k: of_doc.select(F.col("d").alias("hub_" + k), F.col("size").alias("size_" + k))
    known = answers.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), F.col("both").alias("shared")).distinct()
    rest = rest.join(side("a"), "a").join(side("b"), "b").join(size("a"), "hub_a").join(size("b"), "hub_b").withColumn("lo", F.least("hub_a", "hub_b")).withColumn("hi", F.greatest("hub_a", "hub_b"))
    bound = F.coalesce("shared", F.expr(f"{_need('size_a', 'size_b')} - 1"))
    rest = rest.join(known, ["lo", "hi"], "left").filter(bound + F.col("away_a") + F.col("away_b") >= F.expr(_NEED))
    more = compared(rest.select("a", "b"), docs, "rest").filter(_LINK).select("a", "b")
    # classes found so far stand for their links
    final = components(classes.select(F.col("v").alias("a"), F.col("c").alias("b")).union(more))
    return sets.join(final, F.col("doc_id") == F.col("v"), "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without those that link, directly or over others, with one of a smaller doc_id. Of rows with one doc_id any one stays, and rows without go first."""
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(f"`{doc_id}`").cast("long").alias("id"))
    sets = _sets_of(plain)
    if clashing(sets):
        whole = stash(whole.withColumn("row", F.monotonically_increasing_id()), "numbered")
        rows = whole.select(F.col("whole")[text].cast("string").alias("text"), "row", "id")
        found = stash(rows.select("row", "id").join(numbered_classes(rows), "row"), "rows")
        stays = found.groupBy("c").agg(F.min_by("row", F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row"))).alias("stays"))
        gone = found.join(stays, "c").filter("row <> stays").select(F.col("row").alias("gone"))
        whole = whole.drop("id").withColumnRenamed("row", "id")
    else:
        gone = _classes(plain, sets).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone"))
    gone = stash(gone, "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return whole.join(gone, F.col("id") == F.col("gone"), "left_anti").select("whole.*")


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
