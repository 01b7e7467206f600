"""Secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: what every match must contain, of each literal the two trigrams with the
rarest letters. The index is a written table of postings: for each trigram that some query names, the texts whose lower-cased form holds it, by the text's hash.
Equal texts have one posting, a null id is no obstacle, and a hash shared by chance only adds a candidate. Posting lists are intersected and united as each query
says, by merges over their keys, and only the candidates are searched with the rule's expression. A rule without mandatory trigrams (runs of hexadecimal digits) scans every text.

Defined cases: null and empty texts have no spans; texts may be of any length; repeated rows (of one id or of a null id, too) are each searched; an empty
table gives an empty table; other columns pass through, whatever their names; matches are leftmost and do not overlap within one rule; ties in start are
ordered as the rules are listed.
"""

from __future__ import annotations

import re
import re._constants as _C
import re._parser as _parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stash


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: what a match must fulfil besides: a least length of m (the match) or v (its group)
    where: str = "true"
    group: int = 0
    base: bool = False


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "length(v) >= 6", 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", "length(m) >= 20", 0, True),
    Rule("hex", r"[0-9a-f]+", "length(m) >= 24", 0, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"://[A-Za-z0-9._-]+:[^\x20\x09-\x0D/@:]{3,}@"),
)
#: Candidates go to every executor only up to this number (16 bytes each); beyond it they are joined by id.
BROADCAST_CANDIDATES = 500_000


# --- Boolean trigram queries: True (no demand), a str (a trigram), ("and", {...}) or ("or", {...})
def _join(kind: str, parts) -> object:
    out: set = set()
    for p in parts:
        if p is True:
            if kind == "or":
                return True
            continue
        out |= p[1] if isinstance(p, tuple) and p[0] == kind else {p}
    if not out:
        return True
    return next(iter(out)) if len(out) == 1 else (kind, frozenset(out))


#: Letters from common to rare; all other characters are rarer.
_LETTERS = "etaoinshrdlucmfwypvbgkjqxz"


def _of_text(s: str) -> object:
    """The two rarest trigrams by their letters, apart from each other if they can be; a weaker demand loses nothing."""
    at = sorted(range(len(s) - 2), key=lambda i: -sum(_LETTERS.find(c) % 27 for c in s[i : i + 3]))
    return _join("and", [s[i : i + 3] for i in [*at[:1], *[i for i in at if abs(i - at[0]) > 2][:1]]])


_MOST_STRINGS = 16


def _walk(items) -> tuple[set[str] | None, object]:
    """(all strings that the part can match, if they are few, else None; the query for the part), both in lower case."""
    runs: set[str] | None = {""}
    asks: list = []

    def close():
        nonlocal runs
        if runs:
            asks.append(_join("or", [_of_text(r) for r in runs]))
        runs = {""}

    whole = True
    for op, arg in items:
        exact, ask = None, True
        if op is _C.LITERAL:
            exact = {chr(arg).lower()}
        elif op is _C.SUBPATTERN:
            exact, ask = _walk(arg[3])
        elif op is _C.BRANCH:
            sides = [_walk(x) for x in arg[1]]
            exact = set().union(*(e for e, _ in sides)) if all(e is not None for e, _ in sides) else None
            ask = _join("or", [a for _, a in sides])
        elif op is _C.IN and all(k is _C.LITERAL for k, _ in arg) and len(arg) <= 5:
            exact = {chr(v).lower() for _, v in arg}
        elif op in (_C.MAX_REPEAT, _C.MIN_REPEAT):
            low, high, part = arg
            inner, inner_ask = _walk(part)
            if inner is not None and high == 1:
                exact = inner | ({""} if low == 0 else set())
            elif inner is not None and low == high and len(inner) == 1 and high <= 64:
                exact = {next(iter(inner)) * high}
            ask = inner_ask if low else True
        if exact is not None and runs is not None and len(runs) * len(exact) <= _MOST_STRINGS:
            runs = {r + e for r in runs for e in exact}
            continue
        whole = False
        close()
        if exact is not None and len(exact) <= _MOST_STRINGS:
            runs = set(exact)
        else:
            asks.append(ask)
    if whole:
        return runs, _join("or", [_of_text(r) for r in runs])
    close()
    return None, _join("and", asks)


def trigram_query(pattern: str) -> object:
    """What the lower-cased text of every match must hold."""
    return _walk(_parser.parse(pattern))[1]


def trigrams(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*(trigrams(x) for x in query[1]))


def _tree(queries: dict[int, object]) -> tuple[list[str], list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """The queries as one graph of nodes: (trigrams, nodes 0 and on; edges (height of the parent, child, parent, how many of its children the parent needs);
    (root, rule)). Parts that several queries share are one node."""
    names = sorted(set().union(*(trigrams(q) for q in queries.values())))
    node: dict[object, int] = {t: k for k, t in enumerate(names)}
    height: dict[object, int] = dict.fromkeys(names, 0)
    edges: list[tuple[int, int, int, int]] = []

    def add(q) -> int:
        if q not in node:
            parts = [add(x) for x in q[1]]
            node[q], height[q] = len(node), 1 + max(height[x] for x in q[1])
            edges.extend((height[q], k, node[q], len(parts) if q[0] == "and" else 1) for k in parts)
        return node[q]

    return names, edges, [(add(q), k) for k, q in queries.items()]


def postings(texts: DataFrame, names: list[str]) -> DataFrame:
    """The index: (node, key), one for each of the trigrams (by its place in names) and each text (key, text) that holds it; equal texts have one posting."""
    low = texts.select("key", F.lower("text").alias("low"))
    held = low.select("key", F.filter(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(k)) for k, t in enumerate(names)]), lambda x: x.isNotNull()).alias("held"))
    return held.filter(F.size("held") > 0).select(F.explode("held").alias("node"), "key").distinct()


def _values(spark, rows: list[tuple[int, ...]], names: str) -> DataFrame:
    """A table of the rules' making, so no larger than they are."""
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {', '.join(str(r) for r in rows)} AS t({names})"))


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(of, rules): the keys of texts (key, text), and which rules' queries hold.

    The posting lists of a query's parts are merged by key, the inner parts first: where all are demanded a key must stand in every list, else in one. All
    queries are answered by the same merges, one for each level, so the jobs do not grow with the rules."""
    spark = texts.sparkSession
    asked = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not True}
    if not asked:
        return texts.select(F.col("key").alias("of"), F.array().cast("array<int>").alias("rules")).limit(0)
    names, edges, roots = _tree(asked)
    held = stash(postings(texts, names), "postings")
    for level in sorted({e[0] for e in edges}):
        met = held.join(_values(spark, [e[1:] for e in edges if e[0] == level], "child, parent, need"), F.col("node") == F.col("child"))
        met = met.groupBy("parent", "need", "key").agg(F.count(F.lit(1)).alias("n")).filter("n >= need")
        held = held.union(met.select(F.col("parent").alias("node"), "key"))
    found = held.join(_values(spark, roots, "root, rule"), F.col("node") == F.col("root"))
    return found.groupBy(F.col("key").alias("of")).agg(F.sort_array(F.collect_set("rule")).alias("rules"))


def _spans(rule: Rule, k: int) -> Column:
    """Array of (start, k, end): the text is split at the matches, so places are sums of the lengths of gaps and matches. The sums run within blocks of matches and
    then over the blocks, since an array that grows by one copies what it holds."""
    p = F.lit(rule.pattern)
    found = F.struct(F.regexp_extract_all("text", p, F.lit(0)).alias("m"), F.regexp_extract_all("text", p, F.lit(rule.group)).alias("v"), F.split("text", rule.pattern, -1).alias("g"))
    pairs = lambda x: F.arrays_zip(x["m"].alias("m"), x["v"].alias("v"), F.slice(x["g"], 1, F.size(x["m"])).alias("g"))
    none = F.array().cast(_NONE)

    def step(acc, y):
        start = acc["at"] + F.length(y["g"])
        end = start + F.length(y["m"])
        return F.struct(end.alias("at"), F.when(_where(rule, y), F.concat(acc["out"], F.array(F.struct(start.alias("s"), F.lit(k).alias("k"), end.alias("e"))))).otherwise(acc["out"]).alias("out"))

    def within(part):
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("out")), step)

    def over(acc, part):
        shifted = F.transform(part["out"], lambda z: F.struct((acc["at"] + z["s"]).alias("s"), z["k"].alias("k"), (acc["at"] + z["e"]).alias("e")))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(shifted)).alias("out"))

    def summed(y):
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(y) - 1) / MATCHES).cast("int")), lambda b: within(F.slice(y, b * MATCHES + 1, MATCHES)))
        return F.flatten(F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_NONE}>").alias("out")), over, lambda acc: acc["out"]))

    # one-element arrays bind what is used more than once
    return F.transform(F.transform(F.array(found), pairs), lambda y: F.when(F.size(y) > 0, summed(y)).otherwise(none))[0]


def _where(rule: Rule, y: Column) -> Column:
    """rule.where over a match, its parts taken from y."""
    if rule.where == "true":
        return F.lit(True)
    part, least = re.fullmatch(r"length\((m|v)\) >= (\d+)", rule.where).groups()
    return F.length(y[part]) >= int(least)


#: For a scan of every text a rule may be searched by a narrower expression with the same accepted matches: a run of 24 or more is a run.
_NARROW = {"hex": r"[0-9a-f]{24,}+"}
_NONE = "array<struct<s:int,k:int,e:int>>"
#: Matches of a block.
MATCHES = 512


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", broadcast_candidates: int = BROADCAST_CANDIDATES) -> DataFrame:
    """(row, spans): each row's other columns as one struct, and an array of (s, k, e): the start, rule number and end of each match in code points, sorted."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    texts = docs.select(F.struct(*rest).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text"))
    found = stash(candidates(texts.select("key", "text"), rules), "secrets")
    if found.count() <= broadcast_candidates:
        found = F.broadcast(found)
    out = texts.join(found, F.col("key") == F.col("of"), "left")
    parts = []
    for k, r in enumerate(rules):
        if trigram_query(r.pattern) is True:
            narrow = _NARROW.get(r.kind, r.pattern)
            test = F.col("text").rlike(narrow)
            r = Rule(r.kind, narrow, r.where, r.group, r.base)
        else:
            test = F.coalesce(F.array_contains("rules", k), F.lit(False))
        parts.append(F.when(test, _spans(r, k)).otherwise(F.array().cast(_NONE)))
    return out.select("row", F.sort_array(F.concat(*parts)).alias("spans"))


def _text_of(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["k"] < 3)
    of = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    return found.select("row.doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(_text_of(base, RULES), 256).alias("base_sha256"), _text_of(F.col("spans"), RULES).alias("spans"))


def _sql_pattern(r: Rule) -> str:
    """DuckDB has the groups of a pattern numbered alike, but for the keyword, which needs none."""
    return r.pattern.replace("(?i:(password|passwd|secret|token|api_?key))", "(?i:password|passwd|secret|token|api_?key)").replace("'", "''")


def _oracle() -> str:
    parts = []
    for k, r in enumerate(RULES):
        p = _sql_pattern(r)
        v = f"regexp_extract_all(t, '{p}', {1 if r.group else 0})"
        parts.append(f"""SELECT r, {k} AS k, '{r.kind}' AS kind, s, s + length(m) AS e, i FROM (
  SELECT r, m, v, i, (sum(length(m) + length(g)) OVER (PARTITION BY r ORDER BY i) - length(m))::BIGINT AS s FROM (
    SELECT r, unnest(regexp_extract_all(t, '{p}', 0)) AS m, unnest({v}) AS v, unnest(list_slice(string_split_regex(t, '{p}'), 1, len(regexp_extract_all(t, '{p}', 0)))) AS g, generate_subscripts(regexp_extract_all(t, '{p}', 0), 1) AS i FROM d))
  WHERE {r.where}""")
    both = "\nUNION ALL\n".join(parts)
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), found AS ({both}),
a AS (SELECT r, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans FROM found GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)"""


OP10_SQL = _oracle()
