import random

import pytest
from galena.llm.digests import certified_percentiles, digests, estimates, merge_digests

AT = [0.01, 0.25, 0.5, 0.75, 0.99]


def data(spark):
    r = random.Random(2)
    rows = [("a", f"d{i % 5}", r.lognormvariate(10, 3)) for i in range(20_000)] + [("b", "d1", float(r.choice([0, 0, 0, 5, -7]))) for _ in range(2000)]
    rows += [(None, "d1", float(i)) for i in range(7)] + [("c", "d1", None), ("d", "d2", 3.0), ("d", "d2", float("nan"))]
    return spark.createDataFrame(rows, "g string, day string, x double").repartition(6)


def rank_error(values, p, e):
    v = sorted(values)
    rank = max(1, -(-p * len(v) // 1))
    below, upto = sum(x < e for x in v), sum(x <= e for x in v)
    return max(below + 1 - rank, rank - upto, 0) / len(v)


def test_certified(spark):
    df = data(spark)
    rows = certified_percentiles(df, ["g"], "x", AT).collect()
    assert {r.g for r in rows} == {"a", "b", None, "d"} and len(rows) == 20
    for g in ("a", "b", None, "d"):
        v = [r.x for r in df.collect() if r.g == g and r.x is not None and r.x == r.x]
        for r in rows:
            if r.g == g:
                assert r.n == len(v) and r.rank_error == pytest.approx(rank_error(v, r.p, r.estimate), abs=1e-12) and r.rank_error <= 0.01
    assert all(r.rank_error == 0 for r in rows if r.g in ("b", None, "d"))


def test_days_combine(spark):
    df = data(spark)
    whole = {(r.g, r.p): r for r in certified_percentiles(df, ["g"], "x", AT).collect()}
    days = digests(df, ["g", "day"], "x")
    v = [r.x for r in df.collect() if r.g == "a"]
    for r in estimates(merge_digests(days, ["g"]), ["g"], AT).collect():
        assert r.n == whole[(r.g, r.p)].n
        if r.g == "a":
            assert rank_error(v, r.p, r.estimate) <= 0.01


def test_no_groups_and_empty(spark):
    df = data(spark)
    assert digests(df, [], "x").first().n == 22_008
    assert certified_percentiles(df.limit(0), ["g"], "x", AT).count() == 0
