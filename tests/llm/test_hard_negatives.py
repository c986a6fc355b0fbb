import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import hard_negatives as hn
from tests.conftest import SF_ORACLE, SF_SMALL, duck_for
from tests.helpers import same_result
from tests.llm.data import multiset


def con(sf_dir):
    c = duck_for(sf_dir)
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    return c


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_sql(spark, sf_dir):
    same_result(hn.op11_hard_negatives(spark, sf_dir), con(sf_dir), hn.SQL)


def brute(rows):
    """(id, vector, label): every anchor against every row."""
    good = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, v, y) in enumerate(good):
        if i is None or i % 10:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j, z == y) for m, (j, w, z) in enumerate(good) if m != n)
        for s, _, _, p, same in [x for x in scored if x[4]][:5]:
            fits = [x for x in scored if not x[4] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, p, k, x[3], -s, -x[0]) for k, x in enumerate(fits, 1)]
    return out


SCHEMA = "id long, vec array<double>, lab int, row string, block string, score double, cell int"


def held_against_brute(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", "y", 0.5, 3) for r in rows], SCHEMA).repartition(parts)
    got = hn.mine_hard_negatives(df, F.col("id") % 10 == 0, "id", "vec", "lab")
    assert got.columns == [c.split()[0] for c in hn.RESULT.split(", ")]
    assert multiset(got.collect()) == multiset(brute(rows))


def some_rows(n, dims, labels, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    x = centres[rng.integers(0, 8, n)] + rng.normal(size=(n, dims)) * 0.7
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, x[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


def test_edges(spark):
    rows = some_rows(120, 6, 3, 1)
    rows += [(200, None, 1), (210, [0.1] * 6, None), (220, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (230, [float("nan")] * 6, 1), (240, [float("inf")] * 6, 0),
             (None, [0.3] * 6, 1), (None, [0.3] * 6, 2), (250, [0.5, 0.5], 1), (260, [], 0), (270, [0.0] * 6, 2), (280, [-0.4] * 6, 9),
             (30, rows[30][1], 1), (30, rows[30][1], 2), (40, rows[41][1], rows[41][2]), (290, [0.4] * 7, 1), (-10, [0.2] * 6, 0)]
    held_against_brute(spark, rows)
    held_against_brute(spark, [])
    held_against_brute(spark, [(10, [1.0], 1)])
    held_against_brute(spark, [(200, None, 1)])


def test_ties_and_copies_in_small_blocks(spark, monkeypatch):
    """A third of all rows share one vector; cells, blocks and visitor groups hold a few rows."""
    rows = some_rows(240, 5, 4, 2)
    rows += [(1000 + i, [0.6, 0.0, 0.8, 0.0, 0.0], i % 3) for i in range(120)]
    for name, value in (("SAMPLE_ROWS", 40), ("CELL_ROWS", 4), ("BLOCK_ROWS", 7), ("QUERY_ROWS", 5), ("SLICE_ROWS", 6)):
        monkeypatch.setattr(hn, name, value)
    held_against_brute(spark, rows, 4)


def test_wide_integers(spark):
    rng = np.random.default_rng(5)
    held_against_brute(spark, [(i, (rng.normal(size=4) * 1e4).tolist(), i % 2) for i in range(60)])
    with pytest.raises(ValueError):
        hn.Shape(64, 1e9, 256)


def test_heap_gives_all_cells_in_order():
    rng = np.random.default_rng(3)
    for _ in range(50):
        u, v = rng.integers(0, 9, rng.integers(1, 9)).astype(float), rng.integers(0, 9, rng.integers(1, 9)).astype(float)
        floor = float(rng.integers(0, 18))
        got = list(hn.multi_sequence(u, v, floor))
        assert [b for _, _, b in got] == sorted((b for _, _, b in got), reverse=True)
        assert sorted((i, j) for i, j, _ in got) == [(i, j) for i in range(len(u)) for j in range(len(v)) if u[i] + v[j] >= floor]


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(500, 9)) * 100)
    shape = hn.Shape(9, 4.0, 256)
    index = hn.Index(shape, tuple(hn.codebook(h[:50], 4) for h in shape.halves(x)), x[:50], np.zeros(50), np.arange(50))
    homes = [hn.nearest(h, w) for h, w in zip(shape.halves(x), index.words)]
    away = [np.sqrt(((h - w[at]) ** 2).sum(axis=1)) for h, w, at in zip(shape.halves(x), index.words, homes)]
    index.place([(i, j, int(((homes[0] == i) & (homes[1] == j)).sum()), away[0][(homes[0] == i) & (homes[1] == j)].max(), away[1][(homes[0] == i) & (homes[1] == j)].max())
                 for i, j in set(zip(homes[0].tolist(), homes[1].tolist()))])
    u, v = index.bounds(x[:20])
    assert (x[:20] @ x.T <= u[:, homes[0]] + v[:, homes[1]]).all()
