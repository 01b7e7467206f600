import random
import re

import pytest

from docloom.operators.modal import page_bounds, segments

SCHEMA = "doc string, ord long, type string, level long, body string, page long, list_item boolean"
CUTS = re.compile(r"(?:(?<![0-9])[.!?][)\"'”’」』]?[ \t]+|\n+)")
NOTES = re.compile(r"※|\*|†|‡|주\)|주\s*\d+\)|\(\d+\)|\[\d+\]|\d+\)\s")


def starts(s):
    return [m.end() for m in CUTS.finditer(s) if m.end() < len(s)]


def tail(s, budget):
    if len(s) <= budget:
        return s
    cut = len(s) - budget
    back = max([0, *(p for p in starts(s) if p <= cut)])
    ahead = [p for p in starts(s) if p > cut]
    return s[back:] if len(s) - back <= budget + 200 else s[ahead[0]:] if ahead else s[cut:]


def head(s, budget):
    ends = [p for p in starts(s) if p <= budget]
    return s[:ends[-1]].rstrip() if ends else ""


def note(b):
    s = b["s"]
    while b["list_item"] and (m := re.match(r"(?:[-+]|\d+[.)])\s+", s)):
        s = s[m.end():]
    return bool(NOTES.match(s))


def plain(blocks):
    """One document, modal by modal, with a set of the texts that have left their places."""
    blocks = [dict(b, s=(b["body"] or "").strip()) for b in blocks]
    kinds, n, gone, out, count = {"table": "T", "image": "I", "equation": "E"}, len(blocks), set(), {}, {}
    is_text = lambda k: 0 <= k < n and blocks[k]["type"] == "text"
    modal_at = lambda k: 0 <= k < n and blocks[k]["type"] in kinds

    def around(i):
        before, left, k = [], 200, i - 1
        near = []
        while is_text(k) and i - k <= 3:
            near += [k] if blocks[k]["s"] else []
            k -= 1
        for at, k in enumerate(near):
            if left <= 0:
                break
            before.append((k, tail(blocks[k]["s"], left)))
            left -= len(before[-1][1]) + 1
            if blocks[k]["level"] is not None and not (at + 1 < len(near) and blocks[near[at + 1]]["level"] is not None):
                break
        after, left, k = [], 200, i
        while is_text(k := k + 1) and k - i <= 6:
            b = blocks[k]
            if not b["s"]:
                continue
            follows = next((j for j in range(k + 1, n) if not is_text(j) or blocks[j]["s"]), n)
            if b["level"] is not None or (modal_at(follows) and not note(b)):
                break
            if len(b["s"]) > left:
                if note(b) and (h := head(b["s"], left)):
                    after.append((k, h, False))
                break
            after.append((k, b["s"], note(b)))
            left -= len(b["s"]) + 1
        size = len(blocks[i]["body"] or "") + len("\n".join(t for _, t in before)) + len("\n".join(t for _, t, _ in after))
        return ([], [], False) if size > 13800 else (before, after, True)

    for i in range(n):
        if not modal_at(i):
            continue
        before, after, whole = around(i)
        kept = []
        for k, t in before:
            if k in gone:
                break
            kept.append((k, t))
        run, k = [], i - 1
        while is_text(k) and k not in gone:
            run += [k] if blocks[k]["s"] else []
            k -= 1
        closed = modal_at(k) or k in gone
        if whole and closed and run and sum(len(blocks[k]["s"]) for k in run) <= 50 and all(blocks[k]["page"] == blocks[i]["page"] for k in run):
            kept = [(k, blocks[k]["s"]) for k in run]
            gone |= set(run)
        gone |= {k for k, _, moves in after if moves}
        out[i] = "\n".join(t for _, t in reversed(kept)), "\n".join(t for _, t, _ in after)
    parts = []
    for i, b in enumerate(blocks):
        body = b["body"] or ""
        if i in out:
            count[b["type"]] = count.get(b["type"], 0) + 1
            name, (ahead, behind) = kinds[b["type"]] + str(count[b["type"]]), out[i]
            inside = (f"{ahead}\n" if ahead else "") + f"\n{body}" + (f"\n{behind}" if behind else "")
            parts.append((b["ord"], b["type"], name, b["page"], body if len(body) > 13800 else f'〈MODAL id="{name}" type="{b["type"]}"〉{inside}〈/MODAL〉'))
        elif is_text(i) and i not in gone and body:
            parts.append((b["ord"], "text", None, b["page"], "#" * min(b["level"], 6) + " " + body if b["level"] else body))
    return parts


def random_document(rng, doc):
    def text():
        kind = rng.random()
        if kind < 0.25:
            return rng.choice(["", "  ", "Label", "서식1-1", None])
        start = rng.choice(["", "", "", "* ", "※ ", "1) ", "- 2) ", "주 1) ", "(3) "])
        return start + " ".join(rng.choice(["word", "Some more.", "3.5", "and", "end!", "x\ny"]) for _ in range(rng.choice([1, 3, 8, 40, 120])))

    out, page = [], 1
    for k in range(rng.randrange(1, 25)):
        page += rng.random() < 0.15
        kind = rng.choice(["text"] * 6 + ["table"] * 3 + ["image", "equation", "code"])
        body = text() if kind == "text" else rng.choice(["| a |", None, "x" * 13700, "x" * 13790, "y" * 14000]) if kind != "code" else "code"
        level = rng.choice([1, 2, 8]) if kind == "text" and rng.random() < 0.2 else None
        out.append({"doc": doc, "ord": 10 * k, "type": kind, "level": level, "body": body, "page": rng.choice([page, page, page, None]), "list_item": rng.choice([True, False, None]) if kind == "text" else None})
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_plain_fold(spark, seed):
    rng = random.Random(seed)
    docs = [random_document(rng, f"d{k}" if k else None) for k in range(400)]
    rows = [tuple(b.values()) for d in docs for b in d]
    rng.shuffle(rows)
    got = {}
    for r in segments(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.doc, []).append(r)
    moved = 0
    for d in docs:
        want, have = plain(d), sorted(got.get(d[0]["doc"], []), key=lambda r: r.ord)
        assert [(r.ord, r.type, r.modal_id, r.page, r.text) for r in have] == want
        whole = "\n\n".join(t for *_, t in want)
        assert all(whole[r.char_start:r.char_end] == r.text for r in have)
        moved += sum(b["type"] == "text" and bool(b["body"]) for b in d) - sum(r.type == "text" for r in have)
    assert moved > 50


def cut(spark, *blocks):
    rows = [("d", k, kind, level, body, page, False) for k, (kind, level, body, page) in enumerate(blocks)]
    return [(r.type, r.text) for r in sorted(segments(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.ord)]


def test_notes_labels_and_pages(spark):
    one, two = '〈MODAL id="T1" type="table"〉', '〈MODAL id="T2" type="table"〉'
    # a note goes to the table above it, the short rest to the table below
    assert cut(spark, ("table", None, "A", 1), ("text", None, "* note", 1), ("text", None, "Form 1", 1), ("table", None, "B", 1)) == [
        ("table", f"{one}\nA\n* note〈/MODAL〉"), ("table", f"{two}Form 1\n\nB〈/MODAL〉")]
    # a text of another page stays where it is, and is copied
    assert cut(spark, ("table", None, "A", 1), ("text", None, "Form 1", 1), ("table", None, "B", 2)) == [
        ("table", f"{one}\nA〈/MODAL〉"), ("text", "Form 1"), ("table", f"{two}Form 1\n\nB〈/MODAL〉")]
    # the headings above a table come with it, what is above them doesn't; a heading below is the next part's
    assert cut(spark, ("text", None, "Before.", 1), ("text", 2, "Title", 1), ("text", 4, "(2025)", 1), ("table", None, "A", 1), ("text", 1, "Next", 1)) == [
        ("text", "Before."), ("text", "## Title"), ("text", "#### (2025)"), ("table", f"{one}Title\n(2025)\n\nA〈/MODAL〉"), ("text", "# Next")]
    assert cut(spark) == []


def test_pages(spark):
    rows = [("d", 1, "text", None, "abc", 1, False), ("d", 2, "text", None, "de", 1, False), ("d", 3, "text", None, "f", 2, False), ("e", 1, "text", None, "xyz", None, False)]
    got = sorted(tuple(r) for r in page_bounds(segments(spark.createDataFrame(rows, SCHEMA))).collect())
    assert got == [("d", 1, 0, 7), ("d", 2, 9, 10), ("e", 1, 0, 3)]


def test_long_run_of_texts(spark):
    rows = [("d", k, "text", None, f"line {k}.", 1, False) for k in range(20000)] + [("d", 20000, "table", None, "A", 1, False)]
    last = [r for r in segments(spark.createDataFrame(rows, SCHEMA)).collect() if r.type == "table"]
    assert [r.text for r in last] == ['〈MODAL id="T1" type="table"〉line 19997.\nline 19998.\nline 19999.\n\nA〈/MODAL〉']
