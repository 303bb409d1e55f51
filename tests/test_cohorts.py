"""Cohorts of every job against a sequential fold."""

import pandas as pd
import pytest

from tidemark.operators.journal import cohorts
from tidemark.queries import QUERIES

CAP = 100_000_000


def fold(rows, most):
    """The cohort of each (job, k): next fit in order of k."""
    out, state = {}, {}
    for job, k, size in sorted(rows):
        at, held = state.get(job, (0, 0))
        at, held = (at + 1, 0) if held and held + size > most else (at, held)
        state[job] = at, held + size
        out[job, k] = at
    return out


def test_fixture(spark):
    rows = [(1, k, n) for k, n in enumerate([4, 4, 3, 9, 1, 1, 8])] + [(j, k, (7 * j + 3 * k) % 11) for j in range(2, 23) for k in range(j % 6 + 1)]
    got = cohorts(spark.createDataFrame(rows[::-1], "job long, k long, size long"), "job", "k", "size", 10)
    assert {(r.job, r.k): r.cohort for r in got.collect()} == fold(rows, 10)
    assert [fold(rows, 10)[1, k] for k in range(7)] == [0, 0, 1, 2, 2, 3, 3]
    with pytest.raises(Exception, match="exceeds"):
        cohorts(spark.createDataFrame([(1, 1, 11)], "job long, k long, size long"), "job", "k", "size", 10).collect()


def test_registered_query_has_every_order(spark, tmp_path):
    orders = [(c, 100 * c + k, (c * 7919 + k * 104729) % 90_000_000 / 100) for c in range(1, 31) for k in range(8)]
    pd.DataFrame(orders, columns=["o_custkey", "o_orderkey", "o_totalprice"]).to_parquet(tmp_path / "orders.parquet")
    got = QUERIES["w10_cohorts"](spark, str(tmp_path)).collect()
    assert len(got) == len(orders)
    assert {(r.job, r.k): r.cohort for r in got} == fold([(c, k, round(p * 100)) for c, k, p in orders], CAP)
