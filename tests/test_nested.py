import json

from galena.operators.nested import Node, flatten
from pyspark.sql import functions as F

TREE = (Node("lieu", "lieu"), Node("paie", "paie", (Node("prime", "primes", (Node("detail", "d"),)),)))


def nodes(spark, rows, tree=TREE):
    df = spark.createDataFrame(rows, "id string, j string, relation string, label int, text string")
    return {(r["relation"], r["parent_id"], tuple(r["label"]), r["parent_pos"], r["pos"]) for r in flatten(df, F.col("id"), F.col("j"), tree, values=False).collect()}


def rec(i, o):
    return (i, o if isinstance(o, str) or o is None else json.dumps(o), "x", 1, "y")


def test_shapes(spark):
    got = nodes(spark, [
        rec("a", {"lieu": {"x": 1}, "paie": [{"primes": [{"c": 1}, None, {}, {"c": None}, {"c": ""}]}, {"n": None}, {"primes": {"c": 2, "d": [{"z": 0}]}}]}),
        rec("a", {"lieu": {"x": 1}}),
        rec("t", json.dumps({"lieu": json.dumps([{"x": 1}, json.dumps({"x": 2})]), "paie": json.dumps({"primes": json.dumps([{"c": 3}])})})),
        rec("w", json.dumps(json.dumps({"lieu": {"x": [None]}}))),
        rec("cut", '{"lieu":{"x":1},"paie":{"pri'), rec("blank", " "), rec("null", None), rec("lit", "null"), rec("num", "5"), rec(None, {"lieu": {"x": 1}}), rec("arr", [1, 2]),
        rec("long", {"lieu": [{"x": "é" * 100_000}] * 300}),
    ])
    want = {
        ("lieu", "a", (0,), -1, 0), ("paie", "a", (0,), -1, 0), ("prime", "a", (0, 0), 0, 0), ("prime", "a", (0, 4), 0, 4), ("paie", "a", (2,), -1, 2), ("prime", "a", (2, 0), 2, 0), ("detail", "a", (2, 0, 0), 0, 0),
        ("lieu", "t", (0,), -1, 0), ("lieu", "t", (1,), -1, 1), ("paie", "t", (0,), -1, 0), ("prime", "t", (0, 0), 0, 0), ("lieu", "w", (0,), -1, 0),
    } | {("lieu", "long", (i,), -1, i) for i in range(300)}
    assert got == want


def test_column_as_root_values_and_empty(spark):
    df = spark.createDataFrame([("a", '[{"p":[{"q":1}]}]'), ("a", '[{"p":[{"q":1}]}]')], "id string, j string")
    tree = (Node("e", "", (Node("p", "p"),)),)
    rows = {(r["relation"], tuple(r["label"]), r["value"]) for r in flatten(df, F.col("id"), F.col("j"), tree).collect()}
    assert rows == {("e", (0,), '{"p":[{"q":1}]}'), ("p", (0, 0), '{"q":1}')}
    assert flatten(df.limit(0), F.col("id"), F.col("j"), tree).count() == 0


def test_tables_keep_all_fields(spark, tmp_path):
    from galena.plans.general import p3_found, p3_tables

    tables = {
        "offre_brute": ("kafka_partition int, kafka_offset long, json string", [(0, 1, json.dumps({"lieuTravail": {"codePostal": "75001", "commune": "75101"}, "salaire": {"commentaire": "selon profil", "listeComplements": [{"code": "1"}], "neuf": 3}}))]),
        "enrichissement": ("siren string, bodacc_evenements string", [("s", json.dumps([{"type": "vente", "detail": "d", "url": "u", "tribunal": {"ville": "Lyon", "numero": 7}, "pieces": [{"nb_pages": 3}]}]))]),
        "recherche_entreprises": ("siren string, dirigeants string", [("s", json.dumps([{"nom": "N"}]))]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.relation: r.asDict() for r in p3_tables(spark, str(tmp_path)).collect()}
    assert got["lieu"]["codePostal"] == "75001" and got["salaire"]["commentaire"] == "selon profil" and got["piece"]["nb_pages"] == "3"
    assert got["evenement"]["detail"] == "d" and got["evenement"]["url"] == "u"
    assert (got["tribunal"]["ville"], got["tribunal"]["numero"], got["tribunal"]["parent_label"]) == ("Lyon", "7", got["evenement"]["label"])
    assert json.loads(got["salaire"]["autres"]) == {"neuf": "3"} and got["evenement"]["autres"] is None
    assert {r.relation for r in p3_found(spark, str(tmp_path)).collect()} == set(got) - {"tribunal"}
