from galena.operators.snapshots import snapshot_changes

SCHEMA = "v string, k string, `a.b` string, n int, lat double, tags array<string>, _at string"


def changes(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r["v"], r["k"]): (r["change"], r["fields"]) for r in snapshot_changes(df, "k", "v", {"lat": 1e-6}, **kw).collect()}


def row(v, k, a="x", n=1, lat=1.0, tags=("t",), at="p"):
    return (v, k, a, n, lat, list(tags) if tags is not None else None, at)


def test_kinds_of_change(spark):
    rows = [
        row("1", "same"), row("2", "same"), row("2", "same"), row("3", "same"),
        row("1", "gone"), row("2", "new"), row("3", "new"),
        row("1", "space", a="x"), row("2", "space", a="x "), row("3", "space", a=None),
        row("1", "near", lat=1.0), row("2", "near", lat=1.0 + 5e-7), row("3", "near", lat=1.0 + 5e-6),
        row("1", "nul", lat=None), row("2", "nul", lat=2.0), row("3", "nul", lat=2.0),
        row("1", "tags", tags=None), row("2", "tags", tags=()), row("3", "tags", tags=("b",), at=None),
        row("1", "back"), row("3", "back", n=None),
        (None, "x", "", 1, 1.0, [], ""), row("2", None),
    ]
    assert changes(spark, rows) == {
        ("2", "gone"): ("retrait", None), ("2", "new"): ("ajout", None),
        ("2", "space"): ("modification", ["a.b"]), ("3", "space"): ("modification", ["a.b"]),
        ("3", "near"): ("modification", ["lat"]), ("2", "nul"): ("modification", ["lat"]),
        ("2", "tags"): ("modification", ["tags"]), ("3", "tags"): ("modification", ["_at", "tags"]),
        ("2", "back"): ("retrait", None), ("3", "back"): ("ajout", None),
    }


def test_different_rows_of_a_key_are_sets(spark):
    rows = [row("1", "k", a="x"), row("1", "k", a="y"), row("2", "k", a="y"), row("2", "k", a="x"), row("3", "k", a="x")]
    assert changes(spark, rows) == {("3", "k"): ("modification", ["a.b"])}


def test_swapped_nulls_differ(spark):
    a = spark.createDataFrame([("1", "k", None, "x"), ("2", "k", "x", None)], "v string, k string, a string, b string")
    assert [r["fields"] for r in snapshot_changes(a, "k", "v").collect()] == [["a", "b"]]


def test_empty_and_single_version(spark):
    assert changes(spark, []) == {}
    assert changes(spark, [row("1", "k"), row("1", "l")]) == {}
