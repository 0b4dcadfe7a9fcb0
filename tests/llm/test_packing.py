import random
from collections import defaultdict

from galena.llm.packing import fill_containers
from pyspark.sql import functions as F


def containers(rows):
    c = defaultdict(list)
    for r in rows:
        c[r.container].append(r)
    return c


def test_limits_pieces_and_fill(spark):
    r = random.Random(1)
    items = [(i, int(r.lognormvariate(5, 1.2)), "x") for i in range(3000)] + [(9000, 0, "x"), (9001, None, "x"), (9002, -4, "x"), (9003, 2048, "x"), (9004, 2049, "x"), (9005, 1_000_000, "x"), (0, 7, "x")]
    df = spark.createDataFrame(items, "k long, n int, container string")
    rows = fill_containers(df, "k", "n", 2048, most_segments=40, group_items=1000).collect()
    want = sum(max(n or 0, 0) for _, n, _ in items)
    assert sum(x.size for x in rows) == want
    for part in containers(rows).values():
        assert sum(x.size for x in part) <= 2048 and len(part) <= 40
    assert sum(1 for x in rows if x.k == 9005) == 489 and [x.size for x in rows if x.k == 9004] in ([2048, 1], [1, 2048])
    assert {x.k for x in rows} == {k for k, _, _ in items}
    assert want / (2048 * len(containers(rows))) > 0.97


def test_loss_limit(spark):
    df = spark.createDataFrame([(i, 100, 60) for i in range(50)] + [(99, 500, 400)], "k long, n int, loss int")
    rows = fill_containers(df, "k", "n", 1000, loss=F.col("loss"), most_loss=300).collect()
    for part in containers(rows).values():
        assert sum(60 if x.k != 99 else 0 for x in part) <= 300
        assert len(part) == 1 or all(x.k != 99 for x in part)
    assert len(containers(rows)) == 11


def test_empty(spark):
    assert fill_containers(spark.createDataFrame([], "k string, n int"), "k", "n", 10).count() == 0
