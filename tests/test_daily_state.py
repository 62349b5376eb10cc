"""Daily states that take revisions in equal a regrouping of the day."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from gridlake.functions.time import ts_literal
from gridlake.operators import daily_state as DS
from gridlake.operators import medallion as M
from gridlake.schemas import BRONZE

NOW = "2026-03-05 00:00:00"


def silver(spark, hours):
    rows = [(r, t, p, "s", dt.datetime(2026, 3, 4)) for (r, t), p in hours.items()]
    return M.silver(spark.createDataFrame(rows, BRONZE), ts_literal(NOW))


def gold(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_revision_batches(spark, seed):
    rnd = random.Random(seed)
    start = dt.datetime(2026, 3, 27, 20)  # over the change to summer time
    every = [(r, start + dt.timedelta(hours=h)) for r in ("A", "B") for h in range(60)]
    price = lambda: rnd.choice([None, -1.5, 0.0, 2.345, 7.0, 7.0, round(rnd.uniform(-9, 9), 3)])
    hours = {k: price() for k in rnd.sample(every, 50)}
    states = DS.states(silver(spark, hours))
    for _ in range(3):
        before = silver(spark, hours)
        revised = {k: price() for k in rnd.sample(every, 25)}
        hours = hours | revised
        now = silver(spark, hours)
        states = DS.absorb(states, DS.signed_rows(before, silver(spark, revised)), now)
        states = spark.createDataFrame(states.collect(), states.schema)  # as stored
        assert gold(DS.gold(states, ts_literal(NOW))) == gold(M.gold_daily(now, ts_literal(NOW)))


def test_only_lost_extremes_are_read_again(spark):
    day = dt.datetime(2026, 1, 10)
    at = lambda h: ("A", day + dt.timedelta(hours=h))
    hours = {at(1): 5.0, at(2): 5.0, at(3): 9.0, at(4): 7.0}
    states = DS.states(silver(spark, hours))

    def lost(revised):
        changes = DS.signed_rows(silver(spark, hours), silver(spark, revised))
        return DS.apply(states, changes).first().lost

    assert not lost({at(1): 6.0})  # one of two lowest
    assert not lost({at(1): 1.0, at(2): 6.0})  # a new lowest
    assert lost({at(1): 6.0, at(2): 6.0})  # both gone
    assert lost({at(3): 8.0}) and not lost({at(3): 9.5})
    assert not lost({at(5): 7.5})
