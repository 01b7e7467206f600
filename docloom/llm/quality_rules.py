"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes on a document (good, bad) or abstains. Expectation-maximisation estimates, for either class, how often each rule votes which way:
its accuracies; the posterior probability of the class "good" then decides, in place of a demand that all rules pass. Nothing bounds the estimates: a rule
that turns out to be unreliable loses its weight. The rules have few joint outcomes (3 ** rules at most), so the fit runs over a histogram of outcomes
that covers every document.

Defined cases: null and empty texts have no words and fail the base; texts may be of any length; repeated rows are judged alike; an empty table gives
an empty table (the fit then rests on its prior); other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stash

#: Rounds of the fit; on the given tables the estimates move by less than 1e-6 after 25 to 50.
ROUNDS = 60
#: Prior share of good documents (of the weight of one), and for the first round the posterior of documents with and without a "bad" vote.
PRIOR, WITH_BAD, WITHOUT_BAD = 0.8, 0.05, 0.95
SMOOTH = 1.0

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_bangs", "n_stops", "n_letters", "n_lines")

#: name, when it votes "bad", when it votes "good"; over the counts above, in words that Spark and DuckDB share. Else it abstains.
RULES = (
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols < n_words"),
    ("repeats", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words < 5 * n_words"),
    ("dup_lines", "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0"),
    ("capitals", "2 * n_upper > word_chars", "5 * n_upper < word_chars"),
    ("bangs", "5 * n_bangs > n_words", "50 * n_bangs < n_words"),
    ("word_length", "word_chars > 15 * n_words OR 2 * word_chars < 5 * n_words", "word_chars < 10 * n_words AND word_chars > 3 * n_words"),
    ("stops", "n_words >= 50 AND 100 * n_stops < n_words", "30 * n_stops > n_words"),
    ("letters", "100 * n_letters < 90 * word_chars", "100 * n_letters > 94 * word_chars"),
)

#: Up to so many distinct repeated windows of a text are looked up one by one; beyond it windows are sorted with their places. Both count the same.
FEW = 32
_COVERED = "aggregate(transform(p, (v, k) -> CAST(least(3, coalesce(get(p, k + 1) - v, 3)) AS BIGINT)), 0L, (a, b) -> a + b)"
_FEW = "filter(sequence(0, size(_h) - 1), i -> array_contains(_d, _h[i]))"
_MANY = """transform(array(sort_array(transform(_h, (x, i) -> struct(x AS h, i AS i)))), s ->
  sort_array(transform(filter(s, (x, k) -> coalesce(x.h = get(s, k - 1).h, false) OR coalesce(x.h = get(s, k + 1).h, false)), x -> x.i)))[0]"""


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the counts of BASE and MORE. All of it is work within a row: no shuffle, no explode. Steps that several others use are columns of their own, so that each is computed once."""
    only = lambda chars: f"CAST(length(regexp_replace(_text, '[^{chars}]+', '')) AS BIGINT)"
    one = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    two = one.withColumn("_w", F.expr(r"array_remove(split(_text, '[\\x20\\x09-\\x0D]+'), '')")).withColumn("_l", F.expr(r"filter(split(_text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    three = two.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.expr("CAST(length(array_join(_w, '')) AS BIGINT)"),
            "n_symbols": F.expr(only("#*$%&|<>")),
            "n_upper": F.expr(only("A-Z")),
            "n_bangs": F.expr(only("!")),
            "n_stops": F.expr(only(".?;:")),
            "n_letters": F.expr(only(r"\\p{L}")),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": F.expr("CAST(size(_l) - size(array_distinct(_l)) AS BIGINT)"),
            "_h": F.expr("CASE WHEN size(_w) >= 3 THEN transform(sequence(0, size(_w) - 3), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])) END"),
        }
    ).drop("_text", "_l", "_w")
    four = three.withColumn("_s", F.expr("CASE WHEN size(array_distinct(_h)) < size(_h) THEN sort_array(_h) END"))
    five = four.withColumn("_d", F.expr("array_distinct(filter(_s, (x, k) -> coalesce(x = get(_s, k + 1), false)))")).drop("_s")
    six = five.withColumn("_p", F.expr(f"CASE WHEN _d IS NULL OR size(_d) = 0 THEN NULL WHEN size(_d) <= {FEW} THEN {_FEW} ELSE {_MANY} END")).drop("_h", "_d")
    return six.withColumn("n_repeat_words", F.expr(f"CASE WHEN _p IS NULL THEN 0L ELSE {_COVERED.replace('(p', '(_p')} END")).drop("_p")


def votes(counted: DataFrame) -> DataFrame:
    """With v_<rule>: 1 good, 0 bad, -1 abstains."""
    return counted.withColumns({f"v_{name}": F.expr(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END") for name, bad, good in RULES})


def histogram(counted: DataFrame) -> DataFrame:
    """(n, v: the rules' votes in order) of documents with words; 3 ** len(RULES) rows at most, whatever the input."""
    # counts stand behind a grouping: the filter, pushed below it, would compute them all in itself
    names = [f"v_{r[0]}" for r in RULES]
    table = votes(counted).groupBy(*names, (F.col("n_words") > 0).alias("words")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return table.select("n", F.array(*names).alias("v"), "words")


#: Over the histogram as an array of cells (n, v): the posterior of each cell from a model m = [prior, then for each rule how often it votes bad if good, if bad],
#: and the next model from these posteriors p.
_K = len(RULES)
_POSTERIOR = f"""transform(cells, x -> 1 / (1 + exp(-aggregate(sequence(0, {_K - 1}), ln(m[0] / (1 - m[0])),
  (s, k) -> s + CASE x.v[k] WHEN 0 THEN ln(m[2 * k + 1] / m[2 * k + 2]) WHEN 1 THEN ln((1 - m[2 * k + 1]) / (1 - m[2 * k + 2])) ELSE 0D END))))"""
_SUM = "aggregate(zip_with(cells, p, (x, y) -> {}), 0D, (a, b) -> a + b)"
_SHARE = f"({_SUM.format('if(x.v[k] = 0, x.n * {y}, 0D)')} + {SMOOTH}D) / ({_SUM.format('if(x.v[k] >= 0, x.n * {y}, 0D)')} + {2 * SMOOTH}D)"
_MODEL = f"""concat(array(({_SUM.format('x.n * y')} + {PRIOR}D) / ({_SUM.format('x.n')} + 1D)),
  flatten(transform(sequence(0, {_K - 1}), k -> array({_SHARE.replace('{y}', 'y')}, {_SHARE.replace('{y}', '(1 - y)')}))))"""
_FIRST = f"transform(cells, x -> if(array_contains(x.v, 0), {WITH_BAD}D, {WITHOUT_BAD}D))"


def fit(counted: DataFrame, rounds: int = ROUNDS) -> dict:
    """{"prior": share of good, rule: (how often it votes bad, where it votes, if good, if bad)}, estimated over all documents with words.

    The rounds are one expression over the histogram, which has 3 ** len(RULES) cells at most; one row comes back.
    """
    cells = histogram(counted).agg(F.collect_list(F.when(F.col("words"), F.struct("n", "v"))).alias("cells"))
    bind = lambda p, body: f"transform(array({p}), p -> {body})[0]"
    m = cells.select(F.expr(f"aggregate(sequence(2, {rounds}), {bind(_FIRST, _MODEL)}, (m, r) -> {bind(_POSTERIOR, _MODEL)})").alias("m")).first()["m"]
    return {"prior": m[0]} | {f"v_{r[0]}": (m[2 * k + 1], m[2 * k + 2]) for k, r in enumerate(RULES)}


def posterior(model: dict):
    """Column: probability that a document is good, from its votes."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for c, by in model.items():
        if c != "prior":
            odds = odds + F.when(F.col(c) == 0, math.log(by[0] / by[1])).when(F.col(c) == 1, math.log((1 - by[0]) / (1 - by[1]))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(counted: DataFrame, model: dict) -> DataFrame:
    """With base_failed, p_good and kept."""
    v = votes(counted).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")).withColumn("p_good", posterior(model))
    return v.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5)).drop(*[f"v_{r[0]}" for r in RULES])


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without those that are rejected; a null row of a clashing column changes nothing, the row travels as one value."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(f"`{text}`").cast("string").alias("text"))
    # counted once: the rows are kept with their votes' counts, of which only the narrow ones are read for the fit
    counted = stash(counts(whole).drop("text"), "counted")
    return judge(counted, fit(counted)).filter("kept").select("whole.*")


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = stash(counts(docs).select("doc_id", *BASE, *MORE), "quality")
    return judge(counted, fit(counted)).select("doc_id", *BASE, "base_failed", "kept", *MORE)


def counts_sql(table: str, text: str = "text") -> str:
    """DuckDB's form of counts(): doc_id and the counts."""
    gone = lambda chars: f"(length(t) - length(translate(t, '{chars}', '')))::BIGINT"
    return f"""
WITH d AS (SELECT doc_id, coalesce({text}, '') AS t FROM {table}),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM d),
tri AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM dup) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: length(translate(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13), '')) > 0) AS l FROM d)
SELECT d.doc_id, len(w.w)::BIGINT AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars, {gone("#*$%&|<>")} AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, {gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ")} AS n_upper, {gone("!")} AS n_bangs, {gone(".?;:")} AS n_stops,
  length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g'))::BIGINT AS n_letters, len(l)::BIGINT AS n_lines
FROM d JOIN w USING (doc_id) JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)"""


def judge_sql(counted: str) -> str:
    """CTEs over the CTE counted, ending in judged: every column of it, base_failed, p_good and kept. The rounds are written out."""
    names = [f"v_{r[0]}" for r in RULES]
    ctes = [
        "voted AS (SELECT *, " + ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE -1 END AS v_{name}" for name, bad, good in RULES) + f" FROM {counted})",
        f"hist AS (SELECT {', '.join(names)}, count(*) AS n FROM voted WHERE n_words > 0 GROUP BY ALL)",
        f"q0 AS (SELECT *, CASE WHEN least({', '.join(f'abs({c})' for c in names)}) = 0 THEN {WITH_BAD}::DOUBLE ELSE {WITHOUT_BAD}::DOUBLE END AS p FROM hist)",
    ]

    def odds(m: str) -> str:
        return f"ln({m}.prior / (1 - {m}.prior))" + "".join(f" + CASE {c} WHEN 0 THEN ln({m}.{c}_g / {m}.{c}_b) WHEN 1 THEN ln((1 - {m}.{c}_g) / (1 - {m}.{c}_b)) ELSE 0 END" for c in names)

    for r in range(ROUNDS):
        cols = [f"(coalesce(sum(n * p), 0) + {PRIOR}) / (coalesce(sum(n), 0) + 1) AS prior"]
        for c in names:
            for p, k in (("p", "g"), ("(1 - p)", "b")):
                cols.append(f"(coalesce(sum(n * {p}) FILTER (WHERE {c} = 0), 0) + {SMOOTH}) / (coalesce(sum(n * {p}) FILTER (WHERE {c} >= 0), 0) + {2 * SMOOTH}) AS {c}_{k}")
        ctes.append(f"m{r} AS MATERIALIZED (SELECT {', '.join(cols)} FROM q{r})")
        if r < ROUNDS - 1:
            ctes.append(f"q{r + 1} AS MATERIALIZED (SELECT hist.*, 1 / (1 + exp(-({odds(f'm{r}')}))) AS p FROM hist, m{r})")
    last = f"m{ROUNDS - 1}"
    ctes.append(f"judged AS (SELECT *, NOT base_failed AND p_good >= 0.5 AS kept FROM (SELECT voted.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1 / (1 + exp(-({odds(last)}))) AS p_good FROM voted, {last}))")
    return ",\n".join(ctes)


OP2_SQL = f"WITH counted AS ({counts_sql('documents')}),\n{judge_sql('counted')}\nSELECT doc_id, {', '.join(BASE)}, base_failed, kept, {', '.join(MORE)} FROM judged"
