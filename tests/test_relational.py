import datetime as dt

import pytest
from galena.functions import numeric, text
from galena.operators import relational as rel
from galena.sources import lake
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one(spark, column, **values):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean", list: "array<string>", dt.date: "date"}
    schema = ", ".join(f"{k} {'string' if v is None else kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_names_and_keywords(spark):
    assert one(spark, text.company_key(F.col("a")), a="SARL L'Étude Müller & fils ") == "L MULLER FILS"
    assert one(spark, text.company_key(F.col("a")), a=None) == ""
    assert one(spark, text.keyword_class(F.col("a"), F.col("b")), a="Gestionnaire de PAIE", b=None) == "paie"
    assert one(spark, text.keyword_class(F.col("a")), a=None) == "autre"
    assert one(spark, text.jaccard(F.col("a"), F.col("b")), a="X Y", b="Y Z") == pytest.approx(1 / 3)
    assert one(spark, text.jaccard(F.col("a"), F.col("b")), a="", b="") == 0


def test_contacts(spark):
    t = "Tél. 01 23 45 67 89 ou +33 1 23 45 67 89, puis 06.11.22.33.44 ; A.B@Ex.fr a.b@ex.fr x@example.com SIREN 123 456 789"
    assert one(spark, text.phones(F.col("t")), t=t) == ["01 23 45 67 89", "06 11 22 33 44"]
    assert one(spark, text.emails(F.col("t")), t=t) == ["a.b@ex.fr"]
    assert "123456789" in one(spark, text.nine_digit_ids(F.col("t")), t=t)
    assert one(spark, text.phones(F.col("t")), t=None) == []
    html = '<a href="/contact">x</a><a href="mailto:contact@x.fr">m</a><a href="/mentions-legales">y</a><a href="/autre">z</a>'
    assert one(spark, text.contact_links(F.col("t")), t=html) == ["/contact", "/mentions-legales"]
    assert one(spark, text.registrable(text.host(F.col("u"))), u="https://www.a.b.co.uk:80/x?y") == "b.co.uk"
    assert one(spark, text.host(F.col("u")), u="no url") is None


def test_labels_and_departments(spark):
    assert [one(spark, text.count_label(F.col("n")), n=n) for n in (7, 1234, 2000, 2_500_000)] == ["7", "1.2k", "2k", "2.5M"]
    assert [one(spark, text.department(F.col("c")), c=c) for c in ("75056", "97411", "98818")] == ["75", "974", "988"]


def test_numbers(spark):
    assert one(spark, numeric.clip01(F.col("x")), x=2.0) == 1.0
    day = lambda d: one(spark, numeric.half_life(F.col("d"), F.lit("2025-01-31").cast("date"), 30), d=d)
    assert day(dt.date(2025, 1, 1)) == pytest.approx(0.5) and day(dt.date(2025, 2, 1)) == 0
    assert one(spark, numeric.growth(F.col("a"), F.col("b")), a=90, b=-100) == 1.9
    assert one(spark, numeric.growth(F.col("a"), F.col("b")), a=90, b=0) is None
    assert one(spark, numeric.lambert93_latitude(F.col("x"), F.col("y")), x=700000.0, y=6600000.0) == pytest.approx(46.5, abs=1e-7)
    assert one(spark, numeric.lambert93_longitude(F.col("x"), F.col("y")), x=700000.0, y=6600000.0) == pytest.approx(3.0, abs=1e-9)
    assert one(spark, numeric.utm_longitude(F.col("x"), F.col("y"), 2975), x=500000.0, y=7650000.0) == pytest.approx(57.0, abs=1e-9)
    assert one(spark, numeric.utm_latitude(F.col("x"), F.col("y"), 2975), x=500000.0, y=1e7) == pytest.approx(0.0, abs=1e-9)


def test_versions_and_best_rows(spark):
    df = spark.createDataFrame([("1", "a", 1), ("2", "a", 2), ("2", "b", None), (None, "c", 3)], "v string, k string, n int")
    assert {r.k for r in rel.latest(df, "v").collect()} == {"a", "b"}
    assert rel.latest(df.limit(0), "v").count() == 0
    ties = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), (None, 2, "z")], "k string, n int, id string")
    assert {(r.k, r.id) for r in rel.best_per_key(ties, ["k"], [F.col("n").desc(), F.col("id")]).collect()} == {("a", "x"), (None, "z")}
    assert rel.nulled(spark.createDataFrame([("[ND]", 1)], "a string, b int")).first() == (None, 1)


def test_or_join_has_no_nested_loop(spark):
    a = spark.createDataFrame([("x", 1), ("", 2), (None, 3)], "k string, n int")
    b = spark.createDataFrame([("x", "x", 10), ("y", "x", 11), ("", None, 12)], "p string, q string, m int")
    j = rel.or_join(a, b, "k", ["p", "q"])
    assert {(r.n, r.m) for r in j.collect()} == {(1, 10), (1, 11)} and j.count() == 2
    assert "NestedLoop" not in j._jdf.queryExecution().executedPlan().toString()


def test_upsert_and_merge(spark):
    t = spark.createDataFrame([("a", 1, "n"), ("b", 2, None)], "k string, p int, name string")
    c = spark.createDataFrame([("b", 5, "new"), ("c", 6, "c")], "k string, p int, name string")
    assert {tuple(r) for r in rel.upsert(t, c, "k", ["p"], ["name"]).collect()} == {("a", 1, "n"), ("b", 5, "new"), ("c", 6, "c")}
    m = rel.merge_by_key([t, c.withColumnRenamed("p", "q")], "k")
    assert {(r.k, r.p, r.name, r.q) for r in m.collect()} == {("a", 1, "n", None), ("b", 2, "new", 5), ("c", None, "c", 6)}


def test_grid_join_and_filters(spark):
    a = spark.createDataFrame([("a", 48.0, 2.0), ("n", None, 2.0)], "q string, latitude double, longitude double")
    b = spark.createDataFrame([("b", 48.001, 2.0), ("far", 48.1, 2.0)], "p string, latitude double, longitude double")
    leads = spark.createDataFrame([("1", "cgp", "75", "chaud", ["x"], 80, "Alpha", 48.0, 2.0), ("2", None, None, None, None, None, None, None, None)], "siren string, segment string, departement string, bande_score string, flags array<string>, score int, raison_sociale string, latitude double, longitude double")
    for f in (rel.LeadFilter(segments=["cgp"]), rel.LeadFilter(flags=["x", "y"]), rel.LeadFilter(text="aLPh"), rel.LeadFilter(box=(1.0, 47.0, 3.0, 49.0), score_min=80)):
        assert [r.siren for r in leads.where(f.column()).collect()] == ["1"]
    assert leads.where(rel.LeadFilter().column()).count() == 2
    assert rel.clusters(leads, 5).first().n == 1
    assert {r.champ: r.part for r in rel.null_rates(leads.select("siren", "score")).collect()} == {"siren": 0.0, "score": 0.5}


def test_weighted_score(spark):
    w = F.create_map(F.lit("a"), F.lit(3.0), F.lit("b"), F.lit(1.0))
    score, detail = rel.weighted_score({"a": F.lit(1.0), "b": F.lit(None).cast("double"), "c": F.lit(5.0)}, w)
    r = spark.range(1).select(score.alias("s"), detail.alias("d")).first()
    assert r.s == 75 and r.d == {"a": 75.0, "b": 0.0, "c": 0.0}


def test_lake(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "data_version string, k string")
    lake.write_versioned(df, root, manifest={"rows": 2})
    lake.write_versioned(df.where("data_version = '2'").withColumn("k", F.lit("c")), root)
    assert {r.k for r in spark.read.parquet(root).collect()} == {"a", "c"}
    assert lake.versions(spark, root) == ["1", "2"] and lake.read_latest(spark, root).first().k == "c"
    assert lake.read_latest(spark, str(tmp_path / "none"), required=False) is None
    with pytest.raises(FileNotFoundError):
        lake.read_latest(spark, str(tmp_path / "none"))
    assert lake.read_optional(spark, str(tmp_path / "none"), T.StructType([T.StructField("x", T.StringType())])).count() == 0
    assert lake.dimension_from_sheet(spark, [("1000", " A "), ("x", "B")]).collect() == [("1000", "A")]
    with pytest.raises(ValueError):
        lake.same_version(df, df.where("data_version = '1'"))


def test_percent_rank_ties(spark):
    df = spark.createDataFrame([("s", 1), ("s", 1), ("s", 3)], "g string, x int")
    assert sorted(r[0] for r in df.select(F.percent_rank().over(Window.partitionBy("g").orderBy("x"))).collect()) == [0.0, 0.0, 1.0]
