import datetime as dt
import json
import random
from collections import defaultdict

import pytest
from galena.operators.messages import MessageIndex, surplus_messages

SCHEMA = "offre_id string, json string, kafka_ts timestamp, kafka_partition int, kafka_offset long, ingest_date string, id string, h long"


def brute(rows):
    groups = defaultdict(set)
    for i, j, ts, p, o, day, _, _ in rows:
        if i is None:
            try:
                i = json.loads(j)["id"]
            except Exception:
                continue
            if i is None:
                continue
        groups[i.strip().lower()].add((-(ts.timestamp() if ts else -1e18), day or "~", p, o))
    return {(p, o, None if d == "~" else d) for g in groups.values() for _, d, p, o in sorted(g)[1:]}


@pytest.mark.parametrize("prefix", [40_000, 20])
def test_equals_brute_force_with_a_hot_identifier(spark, prefix):
    r = random.Random(4)
    rows, t0 = [], dt.datetime(2025, 4, 1)
    for n in range(1200):
        i = "HOT" if n % 3 == 0 else f"id{r.randrange(400)}"
        shown = r.choice([i, i.lower(), f" {i}\t", f"\u00a0{i}"])
        j = json.dumps({"id": i}) if r.random() < 0.9 else '{"id": "cut'
        own = None if r.random() < 0.1 else shown
        ts = None if r.random() < 0.02 else t0 + dt.timedelta(hours=r.randrange(50))
        rows.append((own, j, ts, r.randrange(3), n, None if r.random() < 0.02 else f"2025-04-{1 + n // 100:02d}", "clash", n))
    rows += [(None, None, t0, 9, 1, "2025-04-01", "x", 1), (None, "{}", t0, 9, 2, "2025-04-01", "x", 1), ("", None, t0, 9, 3, "2025-04-01", "x", 1), (" ", None, t0, 9, 4, "2025-04-01", "x", 1)]
    rows += [("L" * 100_000, None, t0, 9, 5, "2025-04-01", "x", 1), ("l" * 100_000, None, t0, 9, 6, "2025-04-09", "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(x) for x in surplus_messages(df, batches=4, ids_per_prefix=prefix, merge_every=2).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_empty(spark):
    assert surplus_messages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_another_session_goes_on_with_the_index(spark, tmp_path):
    path = str(tmp_path / "index")
    batch = lambda s, rows: s.createDataFrame(rows, "id string, ts long, ingest_date string, part int, off long").selectExpr("id", "xxhash64(id) as h", "ts", "ingest_date", "part", "off")
    first = MessageIndex(spark, prefixes=3, merge_every=1, path=path)
    first.add(batch(spark, [("a", 1, "d1", 0, 1), ("b", 5, "d1", 0, 2), ("b", 4, "d1", 0, 3)]))
    first.add(batch(spark, [("c", 1, "d2", 0, 4)]))
    other = spark.newSession()
    again = MessageIndex(other, prefixes=50, path=path)
    assert again.prefixes == 3 and again.seq == first.seq
    again.add(batch(other, [("a", 2, "d3", 0, 5), ("c", 0, "d3", 0, 6), ("e", 1, "d3", 0, 7)]))
    assert {r.off for r in again.surplus().collect()} == {3, 1, 6}
    assert {(r.id, r.off) for r in MessageIndex(other, path=path).kept().collect()} == {("a", 5), ("b", 2), ("c", 4), ("e", 7)}
