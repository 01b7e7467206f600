import math

import numpy as np
import pytest

from docloom.llm.whitening import block_lanczos, op13_whitening, whiten


def plain(rows, k=4):
    """rows (id, vector) -> n, trace, eigenvalues, and (id, deviation, whitened up to sign)."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    m = np.array(fit, float) - np.array(s) / n
    e, u = np.linalg.eigh(m.T @ m / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = [(i, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)), (np.array(x) - np.array(s) / n) @ u / np.sqrt(e)) for i, x in good]
    return n, np.trace(m.T @ m / n), e, out


def check(got, rows, k=4):
    n, trace, e, want = plain(rows, k)
    by = {}
    for r in got:
        by.setdefault((r.component, r.vec_id), []).append(r)
    assert len(got) == k * len(want) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    for c in range(k):
        assert {round(r.explained, 10) for r in got if r.component == c + 1} == {round(e[c] / trace, 10)}
        pairs = [(by[c + 1, i][0].whitened, w[c]) for i, _, w in want]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-9
    assert all(r.deviation == d for i, d, _ in want for r in by[1, i])


def test_like_a_full_decomposition(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rng.standard_normal((300, 20)) @ np.diag(np.linspace(2, 0.1, 20)))]
    rows += [(1000 + k, rows[5][1]) for k in range(400)] + [(2000, None), (2001, [None, *rows[0][1][1:]]), (2002, [math.nan, *rows[0][1][1:]]), (2003, [math.inf, *rows[0][1][1:]])]
    rows += [(2004, [-0.0, *rows[0][1][1:]]), (2004, [0.0, *rows[0][1][1:]])]
    df = spark.createDataFrame([(i, v, 3, 1.5) for i, v in rows], "vec_id long, embedding array<float>, component int, x double").repartition(6)
    check(whiten(df).collect(), rows)
    check(whiten(df, block=1).collect(), rows)


def test_query(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((50, 5)))]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op13_whitening(spark, str(tmp_path))
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check(got.collect(), rows)


@pytest.mark.parametrize("block", [1, 2, 8])
def test_lanczos_breaks_down_and_starts_anew(block):
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    for e in ([9, 9, 9, 9, 9, 1, *[0] * 34], [5, *[0] * 39], list(range(40, 0, -1)), [1] * 40, [1e9, 1e-3, *[0] * 38], [0] * 40):
        a = (q * np.array(e, float)) @ q.T
        calls = []
        val, vec = block_lanczos(lambda v: calls.append(v.shape) or a @ v, 40, 4, block)  # noqa: B023
        assert np.allclose(val, sorted(e, reverse=True)[:4], atol=1e-10 * max(1, *e))
        assert np.allclose(vec.T @ vec, np.eye(4), atol=1e-12) and np.allclose(a @ vec, vec * val, atol=1e-11 * max(1, *e))
        assert sum(s[1] for s in calls) <= 40


def test_lanczos_needs_few_passes_where_the_spectrum_falls():
    a, calls = np.diag([2.0**-k for k in range(400)]), []
    val, _ = block_lanczos(lambda v: calls.append(1) or a @ v, 400, 4, 8)
    assert np.allclose(val, [1, 0.5, 0.25, 0.125], rtol=1e-12) and len(calls) < 12


def test_few_and_degenerate_vectors(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whiten(make([])).collect() == [] and whiten(make([(1, None), (2, [math.nan])])).collect() == []
    assert whiten(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # one distinct vector
    assert whiten(make([(1, []), (2, [])])).collect() == []
    got = whiten(make([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (None, [5.0])])).collect()  # the last is (5, 0)
    assert len(got) == 6 and {r.vec_id for r in got} == {1, 2, None} and abs(sum(r.explained for r in got if r.vec_id == 1) - 1) < 1e-12
    got = whiten(make([(1, [1.0, 2.0, 3.0]), (2, [3.0, 2.0, 3.0])])).collect()  # a line: one component
    assert [(r.vec_id, r.component, round(abs(r.whitened), 12)) for r in sorted(got)] == [(1, 1, 1.0), (2, 1, 1.0)]


def test_deviations_beyond_a_long_are_exact(spark):
    rows = [(1, [1e13, 0.0]), (2, [-1e13, 1.0]), (3, [0.5, 2.0])]
    got = {r.vec_id: int(r.deviation) for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: d for i, d, _ in plain(rows, 2)[3]}
