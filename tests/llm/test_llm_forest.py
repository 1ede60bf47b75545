import numpy as np

from starward.llm.forest import nearest


def plain(rows, k, every=20):
    fit = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fit[i] = min(fit.get(i, v), v)
    ids = np.array(sorted(fit))
    x = np.array([fit[i] for i in ids])
    out = []
    for q in ids[ids % every == 0]:
        s = x @ np.array(fit[q])
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != q][:k]
        out += [(int(q), n, int(ids[j]), float(s[j])) for n, j in enumerate(order, 1)]
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, id int, v string")
    return sorted(tuple(r) for r in nearest(df, **options).collect())


def compare(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    np.testing.assert_allclose([r[3] for r in got], [r[3] for r in want])


def test_everything_is_searched_with_a_full_share(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(8) * (1 + i % 3)).tolist()) for i in range(300)]
    rows += [(400 + i, rows[20][1]) for i in range(60)] + [(40, rows[7][1])]  # many equal ones; an id twice
    rows += [(500, None), (520, [0.0] * 8), (540, [1.0, None] + [0.0] * 6), (560, [float("nan")] * 8), (580, [float("inf")] * 8), (None, rows[3][1])]
    compare(found(spark, rows, k=20, share=1.0, block_rows=100, query_rows=7), plain(rows, 20))


def test_recall_without_clusters_and_with_them(spark):
    rng = np.random.default_rng(2)
    flat = rng.standard_normal((3000, 64))
    near = rng.standard_normal((30, 64))[rng.integers(0, 30, 3000)] * 2 + flat
    for points in (flat, near):
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        rows = list(enumerate(points.tolist()))
        want = {(r[0], r[2]) for r in plain(rows, 20, 60)}
        got = {(r[0], r[2]) for r in found(spark, rows, every=60)}
        assert len(got & want) / len(want) >= 0.9


def test_few_and_none(spark):
    compare(found(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])]), [(0, 1, 1, 4.0)])
    assert found(spark, [(20, [1.0])]) == []
    assert found(spark, []) == []
    assert found(spark, [(0, None)]) == []
