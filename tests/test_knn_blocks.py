"""Blocks of neighbours: copies grow with the rows, the result does not depend on the blocks."""

import numpy as np

from tabloom.operators import knn


def test_blocks_do_not_grow_with_the_rows_while_they_fit():
    assert {knn._blocks(n, 64) for n in (20_000, 50_000, 200_000)} == {knn.BLOCKS}
    assert knn._blocks(100, 64) == 1
    for n, size in ((10**6, 64), (10**7, 2), (10**6, 4096)):
        assert -(-n // knn._blocks(n, size)) <= max(knn.BLOCK_ROWS, min(knn.BLOCK_MOST, knn.BLOCK_CELLS // size))


def test_slices_and_single_precision(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (300, 3)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(i % 4)) for i, r in enumerate(x)], "id long, v array<float>, y int")
    monkeypatch.setattr(knn, "BLOCK_ROWS", 30)
    monkeypatch.setattr(knn, "BLOCK_SLICE", 7)
    got = {}
    for r in knn.neighbours(df, df, "id", "v", 4, ["y"], True).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour"]
    d = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(-1))
    for i in range(300):
        want = [j for j in np.lexsort((np.arange(300), d[i])) if j != i][:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == want
