"""Relational building blocks: versions, best rows, upserts, joins without nested loops, scores, filters."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galena.functions import numeric


def latest(df: DataFrame, *version: str) -> DataFrame:
    """The rows of the greatest version (a tuple of columns); a tiny aggregate first, so that the filter is a literal
    that reaches the scan. An empty table stays empty."""
    top = df.agg(F.max(F.struct(*version)).alias("v")).select("v.*").first()
    return df.where(F.lit(False)) if top is None or top[0] is None else df.where(reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(top[c])) for c in version]))


def optional(df: DataFrame, name: str, kind: str, default: object = None) -> Column:
    """A column, or where the table lacks it a typed default."""
    return F.col(name).cast(kind).alias(name) if name in df.columns else F.lit(default).cast(kind).alias(name)


def nulled(df: DataFrame, sentinel: str = "[ND]") -> DataFrame:
    """The sentinel becomes null in every string column. Filter before this: no filter is pushed down through it."""
    return df.select(*[F.nullif(F.col(c), F.lit(sentinel)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; Spark limits within tasks before it shuffles. Order must end in a unique column
    for a defined result. Null keys form a group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def _running(counts: DataFrame, group: str, value: str, buckets: int) -> DataFrame:
    """counts (group, value, n) with the number of values before each in its group, as before, without sorting a group
    in one task: values go to ranges of all groups' values, ranges are summed, and each row adds its range's offset to
    the running sum within its range. value is a number and not null."""
    edges = [r.e for r in counts.agg(F.percentile_approx(F.col(value).cast("double"), [i / buckets for i in range(1, buckets)], 20_000).alias("e")).collect()]
    at = F.lit(0)
    for e in sorted(set(edges[0] or [])):
        at = at + (F.col(value) >= e).cast("int")
    c = counts.withColumn("_b", at)
    sums = c.groupBy(group, "_b").agg(F.sum("n").alias("_s"))
    offsets = sums.withColumn("_o", F.coalesce(F.sum("_s").over(Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select(F.col(group).alias("_g"), F.col("_b").alias("_c"), "_o")
    within = F.coalesce(F.sum("n").over(Window.partitionBy(group, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return c.withColumn("_w", within).join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_c"))).select(group, value, "n", (F.col("_w") + F.col("_o")).alias("before"))


def percent_ranks(df: DataFrame, group: str, value: str, name: str, buckets: int = 64) -> DataFrame:
    """df with percent_rank of the value in its group, equal to the window function's: the rows of a group are counted by
    value and by range of values, so that no group has to fit one task. A null group is a group; value is a non-null
    number. A group of one row has rank 0."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    total = df.groupBy(group).agg(F.count(F.lit(1)).alias("_t")).withColumnRenamed(group, "_h")
    ranks = _running(counts, group, value, buckets).select(F.col(group).alias("_g"), F.col(value).alias("_v"), "before")
    j = df.join(ranks, df[group].eqNullSafe(F.col("_g")) & (df[value] == F.col("_v"))).join(total, df[group].eqNullSafe(F.col("_h")))
    return j.withColumn(name, F.when(F.col("_t") > 1, F.col("before") / (F.col("_t") - 1)).otherwise(0.0)).drop("_g", "_v", "_h", "_t", "before")


def exact_medians(df: DataFrame, group: str, value: str, buckets: int = 64) -> DataFrame:
    """(group, median, n): the exact median and number of the non-null values of each group, null and 0 where there are
    none, by counts of values and ranges, so that no group has to fit one task."""
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    sizes = df.groupBy(group).agg(F.count(value).alias("_t")).withColumnRenamed(group, "_h")
    r = _running(counts, group, value, buckets).join(sizes, F.col(group).eqNullSafe(F.col("_h")))
    low, high = F.floor((F.col("_t") - 1) / 2), F.floor(F.col("_t") / 2)
    holds = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
    m = r.groupBy(group).agg(F.max(F.when(holds(low), F.col(value))).alias("_a"), F.max(F.when(holds(high), F.col(value))).alias("_b")).select(F.col(group).alias("_g"), ((F.col("_a") + F.col("_b")) / 2.0).alias("median"))
    return sizes.join(m, F.col("_h").eqNullSafe(F.col("_g")), "left").select(F.col("_h").alias(group), "median", F.col("_t").alias("n"))


def upsert(table: DataFrame, changes: DataFrame, key: str, replace: list[str], keep: list[str]) -> DataFrame:
    """Rows of either side by key: columns in replace come from changes where it has the key, those in keep stay
    unless null. Keys are unique on either side."""
    t, c = table.select(key, *replace, *keep).alias("t"), changes.select(key, *replace, *keep).alias("c")
    both = t.join(c, key, "full_outer")
    hit = F.col(f"c.{replace[0]}").isNotNull() if replace else F.lit(False)
    return both.select(key, *[F.when(hit, F.col(f"c.{x}")).otherwise(F.col(f"t.{x}")).alias(x) for x in replace], *[F.coalesce(f"t.{x}", f"c.{x}").alias(x) for x in keep])


def transition(queue: DataFrame, results: DataFrame, key: str, state: str, new_state: str, attempts: str) -> DataFrame:
    """The queue with results applied: rows that have one take its state and count an attempt. One result a key; keys
    that the queue lacks are ignored."""
    t = queue.join(results.select(key, new_state), key, "left")
    return t.withColumns({state: F.coalesce(new_state, state), attempts: F.col(attempts) + F.col(new_state).isNotNull().cast("int")})


def due(day: Column, number: Column, bands: tuple[tuple[float, int], ...], else_days: int) -> Column:
    """The day after as many days as the first band (least number, days) says that the number reaches."""
    days = F.lit(else_days)
    for least, n in reversed(bands):
        days = F.when(number >= least, n).otherwise(days)
    return F.date_add(day, days)


def merge_by_key(parts: list[DataFrame], key: str) -> DataFrame:
    """Full outer join of tables with one row a key, by one union and one aggregation instead of a chain of joins.
    Columns of several parts: the first non-null in the order of the parts."""
    columns = list(dict.fromkeys(c for p in parts for c in p.columns if c != key))
    kinds = {c: t for p in reversed(parts) for c, t in p.dtypes}
    rows = [p.select(F.col(key), F.lit(i).alias("_i"), *[F.col(c).cast(kinds[c]).alias(c) if c in p.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns]) for i, p in enumerate(parts)]
    u = reduce(DataFrame.unionByName, rows)
    return u.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_i"))).alias(c) for c in columns])


def or_join(left: DataFrame, right: DataFrame, left_key: str, right_keys: list[str]) -> DataFrame:
    """Rows whose left_key equals any of right_keys, as one equi-join on the right side's keys laid one under the
    other; empty and null keys match nothing. A pair that matches by several keys comes once."""
    keys = F.explode(F.array_distinct(F.array_compact(F.array(*[F.nullif(F.col(k), F.lit("")) for k in right_keys])))).alias("_k")
    return left.join(right.select("*", keys), left[left_key] == F.col("_k")).drop("_k")


def weighted_score(parts: dict[str, Column], weights: Column) -> tuple[Column, Column]:
    """(score 0..100, map of what each part adds): parts are shares between 0 and 1, weights a map column by part."""
    w = {k: F.coalesce(F.try_element_at(weights, F.lit(k)), F.lit(0.0)) for k in parts}
    total = F.greatest(sum(w.values(), F.lit(0.0)), F.lit(1.0))
    score = F.round(100 * sum((w[k] * numeric.clip01(p) for k, p in parts.items()), F.lit(0.0)) / total)
    detail = F.create_map(*[x for k, p in parts.items() for x in (F.lit(k), F.round(100 * w[k] * numeric.clip01(p) / total, 1))])
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0)).cast("int"), detail


def chosen(*labels: tuple[Column, str]) -> Column:
    """The labels whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(x)) for c, x in labels]))


@dataclass
class LeadFilter:
    """A filter over scored rows; what is not given does not restrict."""

    segments: list[str] = field(default_factory=list)
    departments: list[str] = field(default_factory=list)
    bands: list[str] = field(default_factory=list)
    flags: list[str] = field(default_factory=list)
    score_min: int | None = None
    text: str | None = None
    box: tuple[float, float, float, float] | None = None  # lon, lat, lon, lat

    def column(self) -> Column:
        """The conjunction; a flag list asks for any of its flags, text for a literal part of the name in any case."""
        c = [F.lit(True)]
        c += [F.col(k).isin(v) for k, v in (("segment", self.segments), ("departement", self.departments), ("bande_score", self.bands)) if v]
        if self.flags:
            c.append(F.arrays_overlap("flags", F.array(*map(F.lit, self.flags))))
        if self.score_min is not None:
            c.append(F.col("score") >= self.score_min)
        if self.text:
            c.append(F.lower("raison_sociale").contains(self.text.lower()))
        if self.box:
            c.append(F.col("longitude").between(self.box[0], self.box[2]) & F.col("latitude").between(self.box[1], self.box[3]))
        return reduce(Column.__and__, c)


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered list; order must end in a unique column."""
    return df.orderBy(*order).offset(offset).limit(limit)


def clusters(df: DataFrame, zoom: int) -> DataFrame:
    """Points by grid cells of 360 / 2^(zoom + 3) degrees: count, centre, least siren."""
    side = 360.0 / 2 ** (min(max(zoom, 0), 22) + 3)
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy(numeric.cell(F.col("longitude"), side).alias("cx"), numeric.cell(F.col("latitude"), side).alias("cy")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("latitude"), 6).alias("lat"), F.round(F.avg("longitude"), 6).alias("lon"), F.min("siren").alias("siren"))


def null_rates(df: DataFrame) -> DataFrame:
    """(champ, part): the share of nulls of each column, in one pass."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return rates.unpivot([], df.columns, "champ", "part")
