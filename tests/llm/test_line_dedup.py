from collections import Counter

from docloom.llm.line_dedup import drop_lines


def test_boilerplate_of_a_host(spark):
    docs = [(k, f"Menu\nown line {k}\n\n \nFooter {k % 2}", "a.org") for k in range(40)] + [(100 + k, f"Menu\nother {k}", f"h{k}") for k in range(5)]
    docs += [(200 + k, f"null host\nx{k}", None) for k in range(8)] + [(300, None, "a.org"), (301, "", "a.org"), (302, "Menu", "a.org"), (302, "Menu", "a.org")]
    docs += [(400, "twice\nonce", "two.org"), (401, "twice", "two.org"), (402, "alone", "one.org"), (403, "long line\n" * 200000 + "end", "a.org")]
    docs += [(500 + k, "shared" if k < 2 else f"own {k}", "a.b") for k in range(15)]
    df = spark.createDataFrame([(*d, "e", 1, 2) for d in docs], "doc_id long, text string, source string, n string, bad int, cut int").repartition(3)
    pages = Counter(h for _, _, h in docs)
    seen = Counter((h, x) for _, t, h in docs for x in set((t or "").split("\n")) if x.strip())
    bad = {k for k, n in seen.items() if n > 1 and n > 0.1 * pages[k[0]]}
    assert ("a.b", "shared") in bad  # 2 of 15 pages
    assert ("two.org", "twice") in bad and not {h for h, _ in bad} & {"one.org", *(f"h{k}" for k in range(5))}
    want = sorted((i, None if t is None else "\n".join(x for x in t.split("\n") if (h, x) not in bad)) for i, t, h in docs if t is not None)
    for most in (0, 10**6):
        got = drop_lines(df, broadcast_lines=most).collect()
        assert sorted((r.row.doc_id, r.text) for r in got if r.text is not None) == want and len(got) == len(docs)
        assert {r.row.doc_id: r.n_dropped for r in got}[3] == 2
        assert {(r.row.n, r.row.bad, r.row.cut) for r in got} == {("e", 1, 2)}
    assert drop_lines(df.limit(0)).collect() == []
