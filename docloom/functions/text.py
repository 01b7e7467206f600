"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def visible_chars(c: Column) -> Column:
    """Characters without tags and white space."""
    return F.length(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"(?U)\s+", ""))


def cjk_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}]"))


def numbering_level(c: Column) -> Column:
    """1 for "1.", 2 for "1.1", 3 for "1.1.1", 4 for "(1)", 5 for "a)"; else 0."""
    out = F.lit(0)
    for level, pattern in ((5, r"^[a-z][)]"), (4, r"^[(][0-9]+[)]"), (1, r"^[0-9]+[.](\x20|$)"), (2, r"^[0-9]+[.][0-9]+(\x20|$)"), (3, r"^[0-9]+[.][0-9]+[.][0-9]+(\x20|$)")):
        out = F.when(c.rlike(pattern), level).otherwise(out)
    return out


def keywords(c: Column, stop: tuple[str, ...], most: int) -> Column:
    """Distinct words of two characters or more that aren't stop words, in order of appearance."""
    parts = F.transform(F.split(F.lower(c), r"[\x20\x09-\x0D,;:/|]+"), lambda w: F.regexp_replace(w, r"^[.()!?\"']+|[.()!?\"']+$", ""))
    return F.slice(F.array_distinct(F.filter(parts, lambda w: (F.length(w) >= 2) & ~w.isin(*stop))), 1, most)


def stable_id(prefix: Column, c: Column) -> Column:
    return F.concat(F.regexp_replace(prefix, "[^A-Za-z0-9_-]", "_"), F.lit("::"), F.substring(F.md5(c), 1, 12))


def clip(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 1), F.lit("…"))).otherwise(c)


def csv_field(c: Column) -> Column:
    return F.when(c.rlike('[,"\n\r]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def a1(row: Column, col: Column) -> Column:
    """Spreadsheet address of a 1-based row and column (to ZZ)."""
    letter = lambda k: F.chr(F.lit(65) + k)
    return F.concat(F.when(col > 26, letter(F.floor((col - 1) / 26).cast("int") - 1)).otherwise(""), letter((col - 1) % 26), row.cast("string"))


def duration(seconds: Column) -> Column:
    s = F.floor(seconds).cast("long")
    return F.when(s >= 3600, F.format_string("%dh %02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))).when(s >= 60, F.format_string("%dm %02ds", F.floor(s / 60), s % 60)).otherwise(F.format_string("%ds", s))


def replaced(c: Column, steps: list[tuple[str, str]]) -> Column:
    """The pairs of pattern and replacement, applied one after the other."""
    for pattern, new in steps:
        c = F.regexp_replace(c, pattern, new)
    return c


def replaced_sql(expr: str, steps: list[tuple[str, str]]) -> str:
    """The same steps as SQL of the oracle, which writes groups as \\1."""
    quote = lambda s: s.replace("'", "''")
    for pattern, new in steps:
        expr = f"regexp_replace({expr}, '{quote(pattern)}', '{quote(new.replace('$', chr(92)))}', 'g')"
    return expr


def compact(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", "")


def one_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def path_frame(parts: Column) -> Column:
    """Segments joined by " > ": blank ones go, and of those that are equal without white space the first stays."""
    lines = F.filter(F.transform(parts, one_line), lambda x: x != "")
    keys = F.transform(lines, compact)
    return F.array_join(F.filter(lines, lambda x, i: F.array_position(keys, compact(x)) == i + 1), " > ")


def sentence_ends(c: Column) -> Column:
    """Lengths of the prefixes that end with a whole sentence: after a stop that follows no digit and precedes white space, or after line breaks."""
    parts = F.split(F.regexp_replace(c, r"((?<![0-9])[.!?][)\"'”’」』]?[ \t]+|\n+)", "$1\x1e"), "\x1e", -1)
    sums = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")), lambda a, p: F.struct((a["at"] + F.length(p)).alias("at"), F.concat(a["ends"], F.array(a["at"] + F.length(p))).alias("ends")))
    return F.filter(sums["ends"], lambda e: e < F.length(c))


def head_to_sentence(c: Column, budget: int) -> Column:
    """The whole sentences that fit into the budget, without white space after the last; a text within it stays as it is."""
    # longer prefixes than the budget can't count, so only the start is searched; two characters more show whether the last stop ends a sentence
    best = F.array_max(F.filter(sentence_ends(F.substring(c, 1, budget + 2)), lambda e: e <= budget))
    return F.when(F.length(c) <= budget, c).when(best.isNull(), "").otherwise(F.regexp_replace(F.substring(c, F.lit(1), best), r"(?U)\s+$", ""))


def tail_from_sentence(c: Column, budget: int, over: int = 200) -> Column:
    """The end of a text, about as long as the budget, from the start of a sentence: of the one that the cut falls in, if that adds no more than over characters;
    else of the next; without either, the last budget characters. Only the end is searched."""
    n = F.length(c)
    cut, off = n - budget, F.greatest(F.lit(0), n - (budget + over + 2))
    starts = F.concat(F.array(F.lit(0)), F.transform(sentence_ends(F.substring(c, off + 1, n)), lambda e: e + off))
    back = F.array_max(F.filter(starts, lambda s: (s <= cut) & (n - s <= budget + over)))
    ahead = F.array_min(F.filter(starts, lambda s: s > cut))
    return F.when(n <= budget, c).otherwise(F.substring(c, F.coalesce(back, ahead, cut) + 1, n))


# fixed values: marks of tables and what they mean
MARKS = {"○": "applicable", "◯": "applicable", "●": "applicable_primary", "◎": "applicable_special", "△": "conditional", "▲": "conditional", "×": "not_applicable", "X": "not_applicable", "✕": "not_applicable", "Y": "yes", "N": "no", "✓": "checked", "✔": "checked", "해당": "applicable", "대상": "applicable", "필수": "required", "선택": "optional"}
UNCLEAR_MARKS = ("O", "o", "0")
MARK_LABELS = {"applicable": "해당", "applicable_primary": "주관", "applicable_special": "특별 해당", "conditional": "조건부 해당", "not_applicable": "비해당", "yes": "예", "no": "아니오", "checked": "체크됨", "required": "필수", "optional": "선택"}
NOTE_STARTS = ("※", "주)", "주:", "주.", "비고", "참고", "단,", "단서", "* ", "(단,", "(※")
TOTALS = ("합계", "소계", "총계", "계", "total", "subtotal")


def lookup(c: Column, values: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def is_mark(c: Column) -> Column:
    t = compact(c)
    return F.coalesce(t.isin(*MARKS, *UNCLEAR_MARKS) | t.rlike("^[○●◎◯△▲×X✕✓✔]+$"), F.lit(False))


def mark_meaning(c: Column) -> Column:
    """Null for what is no mark, and for runs of marks other than circles."""
    t = compact(c)
    return F.coalesce(lookup(t, MARKS), F.when(t.isin(*UNCLEAR_MARKS) | t.rlike("^[○◯]+$"), "applicable").when(t.rlike("^●+$"), "applicable_primary"))


def is_note(c: Column) -> Column:
    t = one_line(c)
    out = F.lit(False)
    for p in NOTE_STARTS:
        out = out | t.startswith(p)
    return F.coalesce(out, F.lit(False))


def is_total(c: Column) -> Column:
    return F.coalesce(F.lower(compact(c)).isin(*TOTALS), F.lit(False))


def is_code(c: Column) -> Column:
    """Short codes: letters and digits like A01, or a few letters or syllables without a space."""
    t = one_line(c)
    return F.coalesce((F.length(t) <= 12) & t.rlike("^(?:[A-Z]{1,5}[0-9]{0,4}|[가-힣]{1,4}|[A-Za-z가-힣]{1,6})$"), F.lit(False))


def is_code_with_note(c: Column) -> Column:
    """A code, or one followed by its meaning in brackets."""
    t = one_line(c)
    return is_code(t) | (F.coalesce(t.rlike(r"^[A-Za-z가-힣0-9]{1,8}\s*\([^()]{1,24}\)$"), F.lit(False)) & is_code(F.regexp_extract(t, r"^([^\s(]*)", 1)))


def is_percent_format(c: Column) -> Column:
    """A percent sign that isn't quoted or escaped."""
    return F.coalesce(F.contains(replaced(c, [('"[^"]*"', ""), (r"\\.", "")]), F.lit("%")), F.lit(False))


def percent_decimals(c: Column) -> Column:
    return F.coalesce(F.length(F.regexp_extract(c, r"0\.(0+)%", 1)), F.lit(0))


def struck(c: Column, is_struck: Column) -> Column:
    """Struck-out text says so in words, once."""
    t = F.coalesce(c, F.lit(""))
    return F.when(is_struck & (t != "") & ~F.rtrim(t).endswith("(취소선)"), F.concat(t, F.lit(" (취소선)"))).otherwise(t)


def digital_length(md: Column) -> Column:
    """Characters of a page's markdown without image lines, tags and white space."""
    return F.length(replaced(F.coalesce(md, F.lit("")), [(r"(^|\n)[ \t]*!\[[^\n]*", "$1"), ("<[^>]+>", ""), (r"\s+", "")]))


def without_markers(c: Column) -> Column:
    """Marks of atomic parts go, what they enclose stays."""
    return replaced(c, [("〈/MODAL〉", ""), ("〈MODAL[^〉]*〉", "")])
