import html
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from docloom.llm.html_extract import _key, blocks, extract, host_of, main_text, style_tree


def page(k, article):
    return f'<!DOCTYPE html><html><head><title>t{k}</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">m{k}</a></li></ul></nav><!-- ad --><div class="ad">ad {k}</div>{article}<footer>&copy; foot {k}</footer></body></html>'


def run(spark, rows, **more):
    df = spark.createDataFrame([(k, f"http://x.org/{k}", h) for k, h in rows], "page_id long, url string, html string").repartition(3)
    return {r.row.page_id: r.main for r in extract(df, **more).collect()}


def brute_tree(pages):
    """Entropies from their definition, page by page: {(host, path): (pages, content, shape)}."""
    texts, shapes = defaultdict(list), defaultdict(list)
    for host, h in pages:
        held = {}
        seen = defaultdict(set)
        for path, _, text in blocks(h or "", held):
            seen[path].add(text)
        for path, x in seen.items():
            texts[host, path].append(x)
        for path, x in held.items():
            shapes[host, path].append("|".join(x))
    out = {}
    for node, x in shapes.items():
        m = len(x)
        if m > 1:
            shape = -sum(n / m * math.log(n / m, m) for n in Counter(x).values())
            on = Counter(t for s in texts[node] for t in s)
            every = [t for s in texts[node] for t in s]
            content = 1 - sum(math.log(on[t], m) for t in every) / len(every) if every else None
            out[node] = (m, content, shape)
    return out


def test_blocks():
    art = "<article><h1>A &amp; B</h1><p><b>bold.<br><p>one <i>t</i>wo\n three</p><section class='comments'><p>reader</p></section><form>x</form></article>"
    assert main_text(page(1, art), {}) == "A & B bold. one two three"
    assert main_text("", {}) == main_text("<p", {}).replace("<p", "") == ""
    assert main_text("<body><header>top</header><p>body text</p><aside>side</aside><!-- open", {}) == "body text"
    assert [b[2] for b in blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>1 < 2")] == ["a", "b", "c", "d", "1 < 2"]
    held = {}
    blocks("<div><p>a<b>b</b></p><p>c</p></div>", held)
    assert held == {">div": ["p p"], ">div>p": ["b", ""]}


def test_tree_against_its_definition(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html", host_of(F.col("url")).alias("host"))
    df = df.unionByName(df.limit(7)).repartition(5)
    want = {(h, _key(path)): x for (h, path), x in brute_tree([(r.host, r.html) for r in df.collect()]).items()}
    got = {(r.host, r.path): (r.pages, r.content, r.shape) for r in style_tree(df).collect()}
    assert set(got) == set(want) and len(want) > 10
    for k, (m, content, shape) in want.items():
        assert got[k][0] == m and abs(got[k][2] - shape) < 1e-9
        assert content is None if got[k][1] is None else abs(got[k][1] - content) < 1e-9


def test_tree_removes_what_a_site_repeats(spark):
    rows = [(k, "http://x.org/%d" % k, f"<body><div class='top'>Welcome to our site</div><div class='x'><p>story {k} {'word ' * k}</p></div><div class='end'>All the same</div></body>") for k in range(20)]
    rows += [(100, "http://one.org/", page(3, "<article><p>Only &lt;one&gt;</p></article>")), (101, None, None), (102, "http://x.org", "")]
    df = spark.createDataFrame([(*r, "extra", "m") for r in rows], "page_id long, url string, html string, row string, main string").repartition(3)
    for most in (0, 10**6):
        out = extract(df, broadcast_nodes=most).collect()
        assert {r.row.page_id: r.main for r in out} == {**{k: " ".join(f"story {k} {'word ' * k}".split()) for k in range(20)}, 100: "Only <one>", 101: "", 102: ""}
        assert {(r.row.row, r.row.main) for r in out} == {("extra", "m")}
    assert extract(df.limit(0)).collect() == []


def test_tree_overrules_what_is_declared(spark):
    story = lambda k: "".join(f"<p>story {k} part {j}</p>" for j in range(k % 9 + 1))
    told = lambda k: " ".join(f"story {k} part {j}" for j in range(k % 9 + 1))
    # the main text beside teasers that call themselves articles
    teasers = run(spark, [(k, f"<body><div class='c'>{story(k)}</div><article class='card'><p>Read our best stories</p></article></body>") for k in range(30)])
    assert teasers == {k: told(k) for k in range(30)}
    # a box without a name that an article prints on every page
    boxes = run(spark, [(k, f"<body><article>{story(k)}<div class='z'>Sign the petition</div></article></body>") for k in range(30)])
    assert boxes == {k: told(k) for k in range(30)}
    # a name that misleads, and a form around the page
    for around in ("<div class='social-science'>{}</div>", "<form>{}</form>", "<div class='site-header-wrap'><article>{}</article></div>"):
        got = run(spark, [(k, f"<body>{around.format(story(k))}<p class='q'>Same line</p></body>") for k in range(30)])
        assert got == {k: told(k) for k in range(30)}
    # comments are as fresh as an article, and still none
    fresh = run(spark, [(k, f"<body><article>{story(k)}</article><section class='comments'>{story(k + 100)}</section></body>") for k in range(30)])
    assert fresh == {k: told(k) for k in range(30)}


def test_importance_decides_on_pages_with_an_article(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(20).collect():
        held = {}
        blocks(r.html, held)
        none, all_ = ({_key(p): (1000, x, x) for p in held} for x in (0.0, 1.0))
        assert main_text(r.html, none) == "" and len(main_text(r.html, all_)) > len(main_text(r.html, {}))


def test_long_and_repeated_pages(spark):
    long = "<body><article>" + "<p>word &amp; word</p>" * 60000 + "</article></body>"
    got = run(spark, [(1, long), (2, "x"), (2, "x")])
    assert got[1] == " ".join(["word & word"] * 60000) and got[2] == "x"


def test_copies_of_a_page_do_not_speak_against_its_article(spark):
    h = "<body><nav>menu</nav><article><p>The one story.</p></article><footer>foot</footer></body>"
    for n in (1, 5, 14, 100):
        assert run(spark, [(k, h) for k in range(n)]) == {k: "The one story." for k in range(n)}
    # each of three pages many times, and one more that is different
    story = lambda k: f"<body><nav>menu</nav><article><p>Story {k}.</p></article><p>Same line</p></body>"
    rows = [(10 * j + k, story(k)) for k in range(3) for j in range(40)] + [(9999, story(77))]
    assert run(spark, rows) == {i: f"Story {77 if i == 9999 else i % 10}." for i, _ in rows}
    # copies do not change what a site's repeats are taken for
    many = [(k, f"<body><div class='a'><p>story {k} {'word ' * k}</p></div><div class='z'>All the same</div></body>") for k in range(30)]
    once = run(spark, many)
    assert once == {k: " ".join(f"story {k} {'word ' * k}".split()) for k in range(30)}
    assert run(spark, [(1000 * j + k, h) for k, h in many for j in range(12)]) == {1000 * j + k: t for k, t in once.items() for j in range(12)}


def test_a_syndicated_article_stays(spark):
    rows = [(k, f"<body><nav>menu</nav><article><p>{'Told by an agency.' if k % 3 == 0 else f'Own story {k}.'}</p></article><p class='d'>day {k}</p></body>") for k in range(60)]
    assert all(("Told by an agency." if k % 3 == 0 else f"Own story {k}.") in t for k, t in run(spark, rows).items())


def test_sample_pages(spark):
    """Against a plain reading of the article element."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.row.page_id: r.main for r in extract(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[r.page_id] == want
