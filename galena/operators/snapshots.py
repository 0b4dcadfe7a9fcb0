"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _col(name: str) -> Column:
    """A column by its name, whatever signs the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def _text(df: DataFrame, c: str) -> Column:
    """A column's value as text, in which different values are different texts."""
    kind = df.schema[c].dataType.typeName()
    return F.to_json(F.struct(_col(c).alias("v"))) if kind in ("array", "map", "struct", "variant") else _col(c).cast("string")


def following_versions(df: DataFrame, version: str) -> DataFrame:
    """(version, next version) of the distinct non-null versions: one small row per snapshot."""
    v = df.where(_col(version).isNotNull()).select(_col(version).alias("_v")).distinct()
    return v.select("_v", F.lead("_v").over(Window.orderBy("_v")).alias("_next"), F.lag("_v").over(Window.orderBy("_v")).alias("_before"))


def _signed(df: DataFrame, versions: DataFrame) -> DataFrame:
    """Each row twice: +1 in the comparison that ends at its version, -1 in the one that starts there. The first
    version ends no comparison, the last starts none."""
    signs = F.array(F.when(F.col("_before").isNotNull(), F.struct(F.col("_v").alias("at"), F.lit(1).alias("sign"))), F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("at"), F.lit(-1).alias("sign"))))
    return df.join(F.broadcast(versions), "_v").select("*", F.explode(F.array_compact(signs)).alias("_s")).select("*", F.col("_s.at").alias("_at"), F.col("_s.sign").alias("_sign")).drop("_s")


def snapshot_changes(df: DataFrame, key: str, version: str, tolerance: dict[str, float] | None = None) -> DataFrame:
    """One row per key and version in which the key was added, removed or changed against the version before:
    (version, key, change, fields). change: ajout, retrait, modification; fields: the sorted names of the changed
    columns (null unless modification).

    Snapshots are unpivoted into signed cells (comparison, key, field, value): +1 for the later version, -1 for the
    former, and a presence cell per key. Cells that both versions hold sum to zero; the nonzero sums classify the
    key. This is done twice, to move little. First each row is one cell, its 128-bit fingerprint, beside the numeric
    columns of tolerance: rows that cancel as a whole never get unpivoted, and what is shuffled is some 60 bytes a
    row. Only keys with a nonzero sum are then unpivoted field by field, with the values themselves.

    Values are compared as they stand, null-safe. Columns in tolerance (double) differ by more than that number, or
    if one is null. Repeated rows count once; if a version holds different rows of a key, the sets of their values
    are compared (the least and greatest numbers for tolerance columns). Rows with null key or version are ignored.
    An empty table or a single version yields nothing. Extra columns take part like any other."""
    tolerance = tolerance or {}
    src = df.where(_col(key).isNotNull() & _col(version).isNotNull())
    fields = [c for c in df.columns if c not in (key, version)]
    plain = [c for c in fields if c not in tolerance]
    near = [c for c in fields if c in tolerance]
    versions = following_versions(df, version)

    texts = [_text(df, c) for c in plain]
    # hash functions skip nulls: a flag beside each value keeps (null, 'a') and ('a', null) apart
    parts = [x for t in texts for x in (t, t.isNull())] or [F.lit(0)]
    rows = src.groupBy(
        _col(version).alias("_v"), _col(key).alias("_k"), F.xxhash64(*parts).alias("_f1"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("_f2"), *[_col(c).cast("double").alias(f"_n{i}") for i, c in enumerate(near)]
    ).agg(F.lit(1).alias("_one"))
    signed = _signed(rows, versions)
    print_sum = [F.sum(F.col("_sign").cast("decimal(38,0)") * F.col(f)).alias(f"_d{f}") for f in ("_f1", "_f2")]
    sums = [F.max(F.col("_sign") > 0).alias("_after"), F.max(F.col("_sign") < 0).alias("_was"), *print_sum]
    changed = ~F.col("_after") | ~F.col("_was") | (F.col("_d_f1") != 0) | (F.col("_d_f2") != 0)
    for i, c in enumerate(near):
        n, bad = F.col(f"_n{i}"), f"_bad{i}"
        sums.append(_differs(n, tolerance[c]).alias(bad))
        changed = changed | F.col(bad)
    keys = signed.groupBy("_at", "_k").agg(*sums).where(changed).select("_at", "_k", "_after", "_was", *[F.col(f"_bad{i}") for i in range(len(near))])

    # Second pass: the cells of the keys that changed. The presence cell is the two flags; added and removed keys are done.
    both = keys.where(F.col("_after") & F.col("_was"))
    sides = both.join(F.broadcast(versions.select(F.col("_v").alias("_at"), F.col("_before"))), "_at")
    wanted = sides.select("_at", "_k", F.explode(F.array(F.struct(F.col("_at").alias("v"), F.lit(1).alias("s")), F.struct(F.col("_before").alias("v"), F.lit(-1).alias("s")))).alias("_w")).select("_at", F.col("_k"), F.col("_w.v").alias("_v"), F.col("_w.s").alias("_sign"))
    parts = []
    if plain:
        unpivoted = src.select(_col(version).alias("_v"), _col(key).alias("_k"), F.struct(*[t.alias(f"c{i}") for i, t in enumerate(texts)]).alias("_r"))
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_r.c{i}").alias("value")) for i, c in enumerate(plain)])).alias("_c")
        one = unpivoted.join(wanted, ["_v", "_k"]).select("_at", "_k", "_sign", cells).select("_at", "_k", F.col("_c.field").alias("_field"), F.col("_c.value").alias("_value"), "_sign")
        net = one.groupBy("_at", "_k", "_field", "_value").agg((F.max(F.when(F.col("_sign") > 0, 1).otherwise(0)) - F.max(F.when(F.col("_sign") < 0, 1).otherwise(0))).alias("_sum"))
        parts.append(net.where(F.col("_sum") != 0).select("_at", "_k", "_field"))
    if near:
        bad = F.explode(F.array_compact(F.array(*[F.when(F.col(f"_bad{i}"), F.lit(c)) for i, c in enumerate(near)]))).alias("_field")
        parts.append(both.select("_at", "_k", bad))
    found = None
    for p in parts:
        found = p if found is None else found.unionByName(p)
    out = keys.where(~(F.col("_after") & F.col("_was"))).select("_at", "_k", F.when(F.col("_after"), "ajout").otherwise("retrait").alias("change"), F.lit(None).cast("array<string>").alias("fields"))
    if found is not None:
        out = out.unionByName(found.groupBy("_at", "_k").agg(F.sort_array(F.collect_set("_field")).alias("fields")).select("_at", "_k", F.lit("modification").alias("change"), "fields"))
    return out.select(F.col("_at").alias(version), F.col("_k").alias(key), "change", "fields")


def _differs(n: Column, tolerance: float) -> Column:
    """Whether a signed numeric cell does not cancel: its values differ by more than tolerance, or by being null."""
    plus, minus = F.when(F.col("_sign") > 0, n), F.when(F.col("_sign") < 0, n)
    absent = lambda side: F.max(F.when((F.col("_sign") > 0) if side else (F.col("_sign") < 0), n.isNull()))
    apart = lambda f: F.coalesce(F.abs(f(plus) - f(minus)) > tolerance, f(plus).isNull() != f(minus).isNull())
    return apart(F.max) | apart(F.min) | F.coalesce(absent(True) != absent(False), F.lit(False))
