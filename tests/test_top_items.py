import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.ml import learners


def _all_pairs(u, x, n):
    score = sum(u[:, d, None] * x[None, :, d] for d in range(u.shape[1]))
    return np.argsort(-score, axis=1, kind="stable")[:, :n]


@pytest.mark.parametrize("kind", ["any", "ties", "equal", "odd"])
def test_boxes_hold_the_greatest_products(kind):
    rng = np.random.default_rng(3)
    for count, rank in ((1, 2), (5, 3), (64, 4), (65, 4), (4_097, 4), (9_000, 1)):
        x, u = rng.normal(size=(count, rank)), rng.normal(size=(60, rank))
        u[0] = 0
        if kind == "ties":
            x = np.round(x)
        elif kind == "equal":
            x[:] = 1
        elif kind == "odd":
            x[0], u[1] = np.nan, np.nan
        n = min(5, count)
        with np.errstate(invalid="ignore"):
            row, item, _ = learners._Boxes(x, 32, u).best(u, 5)
            expected = _all_pairs(u, x, n)
        assert (row.reshape(60, n) == np.arange(60)[:, None]).all() and (item.reshape(60, n) == expected).all()


def test_most_products_are_never_made():
    rng, made = np.random.default_rng(5), []
    # near a plane, as factors of ratings are
    thin = rng.normal(size=(50_000, 3)) @ rng.normal(size=(3, 4)) + 0.02 * rng.normal(size=(50_000, 4))
    u = rng.normal(4, 1, size=(1_000, 4))
    boxes = learners._Boxes(thin, 32, u)
    products = boxes._products

    def counted(*args):
        out = products(*args)
        made.append(out.size)
        return out

    boxes._products = counted
    row, item, _ = boxes.best(u, 5)
    assert sum(made) < 1_000 * 50_000 / 10
    assert (item.reshape(-1, 5)[:50] == _all_pairs(u[:50], thin, 5)).all()


def test_top_items_of_many_blocks_are_those_of_one(spark):
    side = lambda n, seed: spark.range(n).select("id", F.array(*[F.randn(seed + i) for i in range(3)]).alias("factor"))
    users, items = (df.localCheckpoint() for df in (side(300, 1), side(500, 9)))
    one, many = (sorted(map(tuple, learners.top_items(users, items, 4, block).collect())) for block in (None, 70))
    assert one == many and len(one) == 1_200
