"""Spelling variants: words that are one edit apart, by Levenshtein automata over broadcast trie shards.

Words are counted in Spark. Sorted ranges of them become path-compressed tries of bounded size, and so do sorted ranges of the words read backwards; both are
broadcast in groups of bounded size. Each word is cut in two: a neighbour whose edit lies in the tail has the same head, any other one has the same tail. So a
word's automaton of distance one walks, depth-first, only the shards with words that begin with its head and the backward shards with words that end with its
tail; the cut is moved from the middle where that saves shards. A task gives the number of neighbours and the most frequent one, and groups are added up by
word. Forms are followed to their roots by pointer doubling.

Defined cases: null and empty texts hold no words; a null doc_id is written as an empty string where it is hashed; repeated rows count again; words may be of any
length (a path of one word is one edge of the trie); of equally frequent neighbours the first in code-point order is the form; an empty table gives an empty table;
other columns are not read.
"""

from __future__ import annotations

import bisect
import pickle
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stash

#: What a run is, its least length as a word and how often a word occurs at least.
RUN, LEAST_LENGTH, LEAST_COUNT = "[A-Za-zÀ-ÿ]+", 7, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One of so many hashes loses a code point. A form is so many times as frequent.
DAMAGE, RATIO = 31, 10
#: Words and bytes of words in a shard, bytes of the shards that are broadcast at once, words of a task.
SHARD_WORDS, SHARD_BYTES, GROUP_BYTES, TASK_WORDS = 1 << 17, 1 << 22, 1 << 25, 20_000
#: Letters of a shard's first and last word by which words are sent to it.
END = 1024

SHARD_SCHEMA = "size long, first string, last string, shard binary"
CUT_SCHEMA = "word string, n long, head int"
NEAR_SCHEMA = "word string, n_near long, best_n long, best string"


def words_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): runs in lower case, some of them damaged, that are long and frequent enough. Counted before the shuffle."""
    run = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("i"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    run = run.select("i", F.translate("run", UPPER, LOWER).alias("run"))
    run = run.select("run", F.crc32(F.concat("i", F.lit(":"), "run")).alias("h"), F.length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("size")))
    word = F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run"))
    return run.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


class Trie:
    """A path-compressed trie of Latin-1 words in level order: the children of a node stand side by side, each with the text of the edge that leads to it."""

    def __init__(self, words: list[bytes], counts: list[int]):
        """words: distinct and sorted."""
        self.child, self.edge, self.count = array("I"), array("I", [0]), array("q")
        text, first, queue = bytearray(), bytearray(), [(0, len(words), 0)] if words else []
        made = len(queue)
        for k, (lo, hi, depth) in enumerate(queue):  # grows while it is read
            a, b = words[lo], words[hi - 1]
            to, most = depth, min(len(a), len(b))
            if k:  # the root's edge is empty
                while to < most and a[to] == b[to]:
                    to += 1
                first.append(a[depth])
            else:
                first.append(0)
            text += a[depth:to]
            self.edge.append(len(text))
            ends = len(a) == to
            self.count.append(counts[lo] if ends else 0)
            self.child.append(made)
            at = lo + ends
            while at < hi:
                head = words[at][: to + 1]
                end = bisect.bisect_right(words, head, at, hi, key=lambda w, n=to + 1: w[:n])
                queue.append((at, end, to))
                made += 1
                at = end
        self.child.append(made)
        self.text, self.first = bytes(text), bytes(first)

    def near(self, word: bytes, least: int = 0) -> Iterator[tuple[int, bytes]]:
        """(count, neighbour) of all words at a distance of exactly one that share the first least letters, each once: depth-first along the word, and off it by
        the one edit."""
        text, first, child, edge, count, size = self.text, self.first, self.child, self.edge, self.count, len(word)

        def rest(node: int, at: int, i: int) -> int:
            """No edit is left: the count of the word that ends where word[i:] leads from place `at` of the node's edge, or 0."""
            while True:
                part = text[at : edge[node + 1]]
                if not word.startswith(part, i):
                    return 0
                i += len(part)
                if i == size:
                    return count[node]
                node = first.find(word[i], child[node], child[node + 1])
                if node < 0:
                    return 0
                at, i = edge[node] + 1, i + 1

        node, i = 0, 0
        while node >= 0:
            # at a node, with word[:i] read; of equal letters in a row the last one is left out, and a letter is put in behind its like
            lo, hi = child[node], child[node + 1]
            here = word[i] if i < size else -1
            if i < least:
                nxt = first.find(here, lo, hi)
            else:
                if i < size and (i + 1 == size or word[i + 1] != here):
                    if i + 1 == size:
                        n = count[node]
                    else:
                        c = first.find(word[i + 1], lo, hi)
                        n = rest(c, edge[c] + 1, i + 2) if c >= 0 else 0
                    if n:
                        yield n, word[:i] + word[i + 1 :]
                nxt = -1
                for c in range(lo, hi):
                    x = first[c]
                    if x == here:
                        nxt = c
                        continue
                    at = edge[c] + 1
                    if i < size and (n := rest(c, at, i + 1)):
                        yield n, word[:i] + bytes((x,)) + word[i + 1 :]
                    if n := rest(c, at, i):
                        yield n, word[:i] + bytes((x,)) + word[i:]
            node = nxt
            if node < 0:
                return
            at, end, i = edge[node] + 1, edge[node + 1], i + 1
            part = text[at:end]
            if word.startswith(part, i):
                i += len(part)
                continue
            while i < size and text[at] == word[i]:  # within an edge there is but one way to go on
                at, i = at + 1, i + 1
            if i < least:
                return
            x = text[at : at + 1]
            if i < size:
                if n := rest(node, at, i + 1):
                    yield n, word[:i] + word[i + 1 :]
                if n := rest(node, at + 1, i + 1):
                    yield n, word[:i] + x + word[i + 1 :]
            if n := rest(node, at + 1, i):
                yield n, word[:i] + x + word[i:]
            return

    def pack(self) -> bytes:
        return pickle.dumps((self.child, self.edge, self.count, self.text, self.first), 5)

    @classmethod
    def unpack(cls, raw: bytes) -> Trie:
        trie = cls.__new__(cls)
        trie.child, trie.edge, trie.count, trie.text, trie.first = pickle.loads(raw)
        return trie


def shards(most_words: int, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        size = 0

        def made() -> pa.RecordBatch:
            words = sorted(held)
            raw = Trie(words, [held[w] for w in words]).pack()
            ends = [pa.array([w[:END].decode("latin-1")], pa.string()) for w in (words[0], words[-1])]
            return pa.RecordBatch.from_arrays([pa.array([len(raw)], pa.int64()), *ends, pa.array([raw], pa.binary())], names=["size", "first", "last", "shard"])

        for batch in batches:
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = w.encode("latin-1")
                if held and (len(held) >= most_words or size + len(raw) > most_bytes):
                    yield made()
                    held.clear()
                    size = 0
                held[raw] = n
                size += len(raw)
        if held:
            yield made()

    return run


def cut(word: bytes, ends: list[tuple[list[bytes], list[bytes]]]) -> int:
    """Length of the word's head: half of the word, unless that leaves over two shards to walk and another number of sixteenths leaves fewer. ends: the sorted
    first and last words of the shards, forward and backward."""
    back, size = word[::-1], len(word)

    def walks(head: int) -> int:
        n = 0
        for way, least, (firsts, lasts) in ((word, head, ends[0]), (back, size - head, ends[1])):
            key = way[: min(least, END)]
            n += bisect.bisect_right(firsts, key, key=lambda w, k=len(key): w[:k]) - bisect.bisect_left(lasts, key)
        return n

    if walks(size // 2) <= 2:
        return size // 2
    return min(sorted({size * k // 16 for k in range(17)} | {size // 2}, key=lambda k: abs(2 * k - size)), key=walks)


def dealing(ends):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [cut(w.encode("latin-1"), ends.value) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, pa.int32())], names=["word", "n", "head"])

    return run


def searched(group, backward: bool):
    """Rows for the words that have neighbours in the group: with the edit in the tail, or else, in backward shards, with the edit in the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = None
        for batch in batches:
            tries = tries or [(first.encode("latin-1"), last.encode("latin-1"), Trie.unpack(raw)) for first, last, raw in group.value]
            out: list[tuple] = []
            for w, cut_at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw, found, best_n, best = w.encode("latin-1"), 0, 0, b""
                head, way, least = (raw[:cut_at], raw[::-1], len(raw) - cut_at) if backward else (b"", raw, cut_at)
                upto = min(least, END)
                key = way[:upto]
                for first, last, trie in tries:
                    if not first[:upto] <= key <= last[:upto]:
                        continue
                    for m, near in trie.near(way, least):
                        if backward:
                            near = near[::-1]
                            if near.startswith(head):  # found forward
                                continue
                        found += 1
                        if m > best_n or (m == best_n and near < best):
                            best_n, best = m, near
                if found:
                    out.append((w, found, best_n, best.decode("latin-1")))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["word", "n_near", "best_n", "best"])

    return run


def meets(first: str, last: str, backward: bool) -> Column:
    """Whether a word from first to last may begin with this word's head or, all read backwards, with its tail."""
    least = F.least(F.length("word") - F.col("head") if backward else F.col("head"), F.lit(END))
    key, lo, hi = (F.substring(c, F.lit(1), least) for c in (F.reverse("word") if backward else F.col("word"), F.lit(first), F.lit(last)))
    return key.between(lo, hi)


def neighbours(words: DataFrame, shard_words: int = SHARD_WORDS, shard_bytes: int = SHARD_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """words (word, n), distinct Latin-1 words -> (word, n, n_near, best_n, best): the number of words at a distance of one, and the most frequent of them."""
    spark = words.sparkSession
    total = words.count()
    parts = max(1, -(-total // shard_words))

    def sharded(backward: bool) -> DataFrame:
        ranges = words.select(F.reverse("word").alias("word") if backward else "word", "n").repartitionByRange(parts, "word").coalesce(parts).sortWithinPartitions("word")
        return ranges.mapInArrow(shards(shard_words, shard_bytes), SHARD_SCHEMA).withColumn("backward", F.lit(backward))

    made = stash(sharded(False).union(sharded(True)).withColumn("id", F.monotonically_increasing_id()), "shards")
    rows = made.select("backward", "first", "last", "id", "size").orderBy("backward", "first").collect()  # a row for each shard of thousands of words
    ends = [tuple(sorted(r[x].encode("latin-1") for r in rows if r.backward == backward) for x in ("first", "last")) for backward in (False, True)]
    dealt = words.select("word", "n").repartition(max(1, -(-total // TASK_WORDS))).mapInArrow(dealing(spark.sparkContext.broadcast(ends)), CUT_SCHEMA)
    dealt = stash(dealt, "words")
    groups: list[list] = []
    room = 0
    for r in rows:
        if not groups or groups[-1][0].backward != r.backward or r["size"] > room:
            groups.append([])
            room = group_bytes
        groups[-1].append(r)
        room -= r["size"]
    out = dealt.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    for held in groups:
        backward, shard = held[0].backward, made.filter(F.col("id").isin([r.id for r in held])).select("first", "last", "shard")
        group = spark.sparkContext.broadcast([(r["first"], r["last"], bytes(r["shard"])) for r in shard.collect()])  # GROUP_BYTES at most, or one shard
        asked = dealt.filter(meets(held[0]["first"], max(r["last"] for r in held), backward)).select("word", "head")
        found = stash(asked.mapInArrow(searched(group, backward), NEAR_SCHEMA), "near")
        group.unpersist()
        out = out.union(found.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best"))
    best = F.min(F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("a"), F.col("best").alias("b"))))
    return out.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("x")).select("word", "n", "n_near", (-F.col("x.a")).alias("best_n"), F.col("x.b").alias("best"))


def variants(words: DataFrame, ratio: int = RATIO, **bounds: int) -> DataFrame:
    """words (word, n) -> word, n, n_near, form, form_n, root."""
    near = neighbours(words, **bounds)
    takes = F.col("best_n") >= ratio * F.col("n")
    out = stash(near.select("word", "n", "n_near", F.when(takes, F.col("best")).alias("form"), F.when(takes, F.col("best_n")).alias("form_n")), "forms")
    # n grows tenfold with each step, so that a way has some twenty steps and doubling some five rounds
    way = stash(out.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        on = stash(way.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        way = on.select("word", "root")
        if not on.filter("moved").limit(1).count():
            break
    return out.join(way, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(stash(words_of(spark.read.parquet(f"{sf_dir}/documents.parquet")), "counts")).select("word", "form", "root", "n", "n_near", "form_n")


OP12_SQL = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS i, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT i, run, count(*) AS k FROM runs GROUP BY ALL),
bytes AS (
    SELECT i, run, k, flatten(list_transform(string_split(i || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) % 64)::BIGINT] END)) AS b FROM counted),
hashed AS (
    SELECT run, k, length(run) AS size, xor(list_reduce(b, lambda h, x: xor(h >> 8, t[CAST(xor(h, x) % 256 AS BIGINT) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM bytes, crc),
spelled AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, k FROM hashed),
words AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
gaps AS MATERIALIZED (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS gap FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.p = b.p AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM gaps a JOIN words b ON a.gap = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM gaps a JOIN words b ON a.gap = b.word),
best AS (SELECT word, any_value(n) AS n, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
ways(word, stop) AS (SELECT word, form FROM forms WHERE form IS NOT NULL UNION ALL SELECT ways.word, f.form FROM ways JOIN forms f ON f.word = ways.stop WHERE f.form IS NOT NULL),
roots AS (SELECT ways.word, stop AS root FROM ways JOIN forms f ON f.word = ways.stop WHERE f.form IS NULL)
SELECT forms.word, form, coalesce(root, forms.word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots ON roots.word = forms.word
"""
