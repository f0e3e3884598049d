import math

import numpy as np

from marquee.llm import embed_dedup as E

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string"


def brute(rows, threshold):
    n = len(rows)
    vectors = [None if r[1] is None or r[2] is None or r[0] is None or not r[1] or any(x is None or not math.isfinite(x) for x in r[1])
               or not any(r[1]) else np.array(np.array(r[1], dtype=np.float32), dtype=np.float64) for r in rows]
    links, up = [0] * n, list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(n):
        for b in range(a):
            x, y = vectors[a], vectors[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y):
                if (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    up[root(a)] = root(b)
    least = {}
    for k in range(n):
        if rows[k][0] is not None:
            least[root(k)] = min(rows[k][0], least.get(root(k), rows[k][0]))
    return sorted((-1 if rows[k][0] is None else rows[k][0], links[k], least.get(root(k), -1)) for k in range(n))


def found(df):
    null = lambda x: -1 if x is None else x
    return sorted((null(r["vec_id"]), r["n_links"], null(r["component_id"])) for r in df.collect())


def made(rng, groups, each, dim=32, labels=3):
    rows = []
    for _ in range(groups):
        centre, label = rng.normal(size=dim), int(rng.integers(labels))
        for _ in range(each):
            rows.append((len(rows), (centre + rng.normal(size=dim) * 0.3 * rng.random()).astype(np.float32).tolist(), label, None))
    return rows


def test_small_labels_are_exact(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 7)  # buckets in several blocks
    rows = made(np.random.default_rng(2), 20, 12)
    rows += [(900, rows[0][1], rows[0][2], "x"), (901, [2 * x for x in rows[0][1]], rows[0][2], None), (902, None, 1, None),
             (903, rows[0][1], None, None), (904, [0.0] * 32, 1, None), (905, [math.nan] + rows[0][1][1:], rows[0][2], None),
             (906, [None] + rows[0][1][1:], rows[0][2], None), (907, [math.inf] * 32, 1, None), (908, [], 1, None),
             (909, rows[0][1][:16], rows[0][2], None), (900, rows[0][1], rows[0][2], None), (None, rows[0][1], rows[0][2], None)]
    df = E.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = df.collect()
    assert found(df) == brute(rows, 0.93)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_recall_with_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(E, "BUCKET_ROWS", 8)
    rows = made(np.random.default_rng(5), 60, 10, labels=2)
    want = brute(rows, 0.93)
    got = found(E.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(w[1] for w in want) > 500
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    code, factor = E.encode(x)
    estimate, bound = E.estimates(x, code, factor)
    error = (estimate - x @ x.T)[~np.eye(400, dtype=bool)]
    assert abs(error.mean()) < 0.005
    assert (np.abs(estimate - x @ x.T) <= bound).mean() > 0.999


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_cells_are_exact(spark, monkeypatch):
    monkeypatch.setattr(E, "BUCKET_ROWS", 8)
    monkeypatch.setattr(E, "ROUTE_ROWS", 50)
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = made(rng, 80, 10, labels=2)  # many pairs near the threshold
    rows += [(len(rows) + k, r[1], 7, None) for k, r in enumerate(made(rng, 1, 6))]  # and a label of a handful
    want = brute(rows, 0.93)
    assert found(E.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == want
    assert sum(w[1] for w in want) > 500


def test_linked_pairs_meet_once_in_a_cell_and_are_within_the_bound():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    home, visit = E.cells(x, x[:9], 0.93)
    code, factor = E.encode(x)
    estimate, bound = E.estimates(x, code, factor)
    assert (np.abs(estimate - x @ x.T) <= bound * np.sqrt(np.maximum(0, 1 - (x @ x.T) ** 2)) + 1e-6).all()
    assert visit.mean() < 0.4  # far cells are spared
    for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.93, 1)), strict=True):
        late, early = (a, b) if home[a] >= home[b] else (b, a)
        assert home[late] == home[early] or visit[late, home[early]]
