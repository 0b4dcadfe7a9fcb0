from galena.llm import entities


def test_names_are_normalized_once(spark):
    """Neither the rows before the distinct nor the filters after it normalize a name again."""
    df = spark.createDataFrame([(n,) for n in ("Cabinet Phaljouzat", "Cabinet Phaljouzat", "XXX", "SARL", "Boulangerie Rebulin & Fils", None)], "name string")
    named = entities._named(df, "name")
    assert "regexp_replace" not in named._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.core, *r.kinds) for r in named.collect()} == {("PHALJOUZAT",), ("REBULIN FILS", "table")}
