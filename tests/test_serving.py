import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from galena.functions import text
from galena.operators import relational as rel
from galena.operators import serving
from galena.streaming import append

LEADS = [("812345678", "CABINET DURAND", "avocat", "44", 88, 2, False), ("902345671", "EC LOIRE", "expert_comptable", "49", 72, 0, None), ("444555666", "SCP NOTAIRES", "notaire", "56", 41, 0, True)]


@pytest.fixture()
def leads(spark):
    return spark.createDataFrame(LEADS, "siren string, raison_sociale string, segment string, departement string, score int, nb_offres_30j int, est_client boolean")


def listed(leads, condition):
    return serving.listed(leads, condition, [F.col("score").desc(), F.col("siren")], 50).collect()


def test_list_leaves_out_clients(leads):
    rows = listed(leads, serving.not_excluded(F.col("est_client")))
    assert [r.score for r in rows] == [88, 72] and {r.total for r in rows} == {2}
    assert len(listed(leads, F.lit(True))) == 3
    assert [r.siren for r in listed(leads, rel.LeadFilter(segments=["avocat"]).column())] == ["812345678"]
    assert [r.siren for r in listed(leads, F.col("nb_offres_30j") > 0)] == ["812345678"]
    assert serving.listed(leads, F.lit(True), [F.col("siren")], 5, 10).count() == 0


def test_lookup_and_kpi(spark, leads):
    got = {r.siren: (r.found, r.raison_sociale) for r in serving.lookup(leads.unionByName(leads), "siren", ["902345671", "000000000", "000000000"], ["raison_sociale"]).collect()}
    assert got == {"902345671": (True, "EC LOIRE"), "000000000": (False, None)}
    assert serving.lookup(leads.limit(0), "siren", [], ["score"]).count() == 0
    assert serving.kpi({"kpi_marche": leads}, "kpi_marche").count() == 3
    with pytest.raises(serving.UnknownKpi):
        serving.kpi({"autre": leads}, "autre")
    with pytest.raises(serving.UnknownKpi):
        serving.kpi({}, "kpi_marche")
    assert serving.departments("53") == ["22", "29", "35", "56"] and serving.departments("xx") == []


def test_ranks_and_medians_equal_window_functions(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), r.choice([0, 0, 0, r.randrange(1000)])) for _ in range(700)] + [("one", 5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    w = Window.partitionBy("g").orderBy("v")
    full = df.where("v is not null")
    want = sorted((str(x.g), x.v, round(x.p, 9)) for x in full.select("g", "v", F.percent_rank().over(w).alias("p")).collect())
    assert sorted((str(x.g), x.v, round(x.p, 9)) for x in rel.percent_ranks(full, "g", "v", "p").collect()) == want
    want = {x.g: (x.m, x.n) for x in df.groupBy("g").agg(F.median("v").alias("m"), F.count("v").alias("n")).collect()}
    assert {x.g: (x.median, x.n) for x in rel.exact_medians(df, "g", "v").collect()} == want
    assert rel.percent_ranks(full.limit(0), "g", "v", "p").count() == 0 and rel.exact_medians(df.limit(0), "g", "v").count() == 0


def test_territories(spark):
    df = spark.createDataFrame([(652709.4, 6862305.3, "75001"), (0.0, 0.0, "75001"), (None, None, None), (340000.0, 7650000.0, "97411"), (340000.0, 7650000.0, "75001")], "x double, y double, c string")
    lat, lon = serving.placed_from_plane(F.col("x"), F.col("y"), F.col("c"), {"974": 2975}, {"974": (55, -22, 56, -20)}, (-6, 41, 11, 52))
    got = df.select(F.round(lat, 2).alias("a"), F.round(lon, 2).alias("o")).collect()
    assert (got[0].a, got[0].o) == (48.86, 2.36) and got[1].a is None and got[2].a is None and -22 < got[3].a < -20 and 55 < got[3].o < 56 and got[4].a is None


def test_transition_and_labels(spark):
    q = spark.createDataFrame([("a", "neuf", 0), ("b", "neuf", 1)], "k string, etat string, n int")
    r = spark.createDataFrame([("a", "fait"), ("z", "fait")], "k string, e string")
    assert sorted((x.k, x.etat, x.n) for x in rel.transition(q, r, "k", "etat", "e", "n").collect()) == [("a", "fait", 1), ("b", "neuf", 1)]
    one = spark.range(1)
    assert one.select(text.person_label(F.lit("JEAN DUPONT"), F.lit(None).cast("string"), F.lit(False))).first()[0] == "Jean Dupont"
    assert one.select(text.phones(F.lit("+33 (0)1 23 45 67 89, 0033 6 11 22 33 44"))).first()[0] == ["01 23 45 67 89", "06 11 22 33 44"]


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, sink = str(tmp_path / "in"), append.DaySink(str(tmp_path / "out"), str(tmp_path / "state"))
    for part in range(2):
        spark.range(part * 10, part * 10 + 10).write.mode("append").parquet(source)
        sink.start(append.file_source(spark, source)).awaitTermination()
        out = spark.read.parquet(sink.path)
        assert sorted(r.id for r in out.collect()) == list(range(part * 10 + 10)) and "ingest_date" in out.columns
    assert append.Pace(30).options() == {"processingTime": "30 seconds"}
