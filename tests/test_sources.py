from pyspark.sql import functions as F

from docloom.sources import files


def test_documents(spark, tmp_path):
    (tmp_path / "a.TXT").write_bytes("été".encode())
    (tmp_path / "b.txt").write_bytes(b" ")
    (tmp_path / "c.xlsx").write_bytes(b"PK")
    got = {r.path.rsplit("/", 1)[1]: (r.domain, r.text, r.status) for r in files.documents(spark, str(tmp_path)).collect()}
    assert got == {"a.TXT": ("text", "été", "ok"), "b.txt": ("text", " ", "failed"), "c.xlsx": ("excel", None, "ok")}


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    got = [(r.a, r._error) for r in files.json_lines(spark, str(tmp_path), "a int").collect()]
    assert got == [(1, None), (None, "not json"), (2, None)]


def test_csv_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text('h1,h2\n\n"a,""b""",=1+1\n')
    got = {(r.row, r.col): r.value for r in files.csv_cells(spark, str(tmp_path)).collect()}
    assert got == {(1, 1): "h1", (1, 2): "h2", (3, 1): 'a,"b"', (3, 2): "=1+1"}


def test_pages_and_ranges(spark):
    df = spark.createDataFrame([("  <p>one<p>two", "1-3, 5,2")], "t string, r string")
    row = df.select(files.pages(F.col("t"), "<p>").alias("p"), files.page_range(F.col("r")).alias("r")).first()
    assert [tuple(x) for x in row.p] == [(2, "one"), (3, "two")] and row.r == [1, 2, 3, 5]


def test_offload(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y" * 50)], "k int, p string")
    got = {r.k: (r.inline, r.ref is None) for r in files.offload(df, "p", 10).collect()}
    assert got == {1: ("x", True), 2: (None, False)}
