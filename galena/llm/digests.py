"""Percentiles of large numeric columns by merging centroid digests, with certified rank errors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galena.session import bounded

DIGEST = "n long, low double, high double, means array<double>, weights array<long>, solid array<boolean>"
_COLUMNS = ["n", "low", "high", "means", "weights", "solid"]


def _cluster(means: np.ndarray, weights: np.ndarray, solid: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges sorted weighted values into at most about size centroids. A centroid spans at most one unit of
    k(q) = size / pi * (asin(2q - 1) + pi / 2), so that centroids near either end stay small. Equal values share one;
    solid says of a centroid that it holds a single value."""
    if not len(means):
        return means, weights, solid
    starts = np.concatenate([[0], np.flatnonzero(np.diff(means) != 0) + 1])
    weights, solid, means = np.add.reduceat(weights, starts), np.logical_and.reduceat(solid, starts), means[starts]
    if len(means) <= size // 2:
        return means, weights, solid
    total = weights.sum()
    after = np.cumsum(weights)
    k = lambda q: size / np.pi * (np.arcsin(np.clip(2 * q - 1, -1, 1)) + np.pi / 2)
    # a centroid belongs to the unit in which its middle lies; one heavier than a unit stays alone
    unit = np.floor(k((after - weights / 2) / total)).astype(np.int64)
    heavy = k(after / total) - k((after - weights) / total) > 1
    edge = np.ones(len(means), bool)
    edge[1:] = (unit[1:] != unit[:-1]) | heavy[1:] | heavy[:-1]
    starts = np.flatnonzero(edge)
    w = np.add.reduceat(weights, starts)
    one = np.diff(np.append(starts, len(means))) == 1
    m = np.where(one, means[starts], np.add.reduceat(means * weights, starts) / w)
    return m, w, one & solid[starts]


def digest(values: np.ndarray, size: int) -> tuple[int, float, float, np.ndarray, np.ndarray, np.ndarray]:
    """The digest of values without nulls."""
    v = np.sort(values.astype(np.float64))
    return len(v), v[0], v[-1], *_cluster(v, np.ones(len(v), np.int64), np.ones(len(v), bool), size)


def merge(rows: pd.DataFrame, size: int) -> tuple[int, float, float, np.ndarray, np.ndarray, np.ndarray]:
    """One digest from several, by clustering their centroids again."""
    m, w, s = (np.concatenate([np.asarray(x, kind) for x in rows[c]]) for c, kind in (("means", np.float64), ("weights", np.int64), ("solid", bool)))
    order = np.argsort(m, kind="stable")
    return int(rows["n"].sum()), rows["low"].min(), rows["high"].max(), *_cluster(m[order], w[order], s[order], size)


def quantiles(n: int, low: float, high: float, means: np.ndarray, weights: np.ndarray, solid: np.ndarray, at: list[float]) -> np.ndarray:
    """Estimates of the values of rank ceil(p * n): a centroid of a single value is a step; within others, linear
    between the middles of the centroids. The ends are the least and the greatest value."""
    means, weights, solid = np.asarray(means, float), np.asarray(weights, float), np.asarray(solid, bool)
    after = np.cumsum(weights)
    rank = np.clip(np.ceil(np.asarray(at) * n - 1e-9), 1, n)
    here = np.minimum(np.searchsorted(after, rank), len(means) - 1)
    x = np.concatenate([[0.5], after - weights / 2, [n - 0.5]])
    return np.where(solid[here], means[here], np.interp(rank - 0.5, x, np.concatenate([[low], means, [high]])))


def digests(df: DataFrame, groups: list[str], value: str, size: int = 400, fan_in: int = 64) -> DataFrame:
    """(groups, n, low, high, means, weights): one digest of the non-null, non-NaN values of each group; nulls in a
    group column are a group. Groups without a value give no row. Rows count as they stand, repeated ones too.

    Each task reduces its rows to digests of at most about size centroids per group, whatever the skew: a group with
    most of all rows sends one digest per task. They are merged in two rounds, first fan_in at a time."""
    keys = [f"_g{i}" for i in range(len(groups))]
    src = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    kinds = ", ".join(f"`{k}` {df.schema[g].dataType.simpleString()}" for g, k in zip(groups, keys))
    schema = f"{kinds}, {DIGEST}" if keys else DIGEST

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            # groupby drops no nulls and keeps the batch small: centroids, not rows, are held
            parts = b.groupby(keys, dropna=False, sort=False)["_x"] if keys else [((), b["_x"])]
            rows = [(*(g if isinstance(g, tuple) else (g,)), *digest(x.to_numpy(), size)) for g, x in parts]
            held.append(pd.DataFrame(rows, columns=[*keys, *_COLUMNS]))
            if len(held) >= 32:
                held = [_merged(pd.concat(held), keys, size)]
        if held:
            yield _merged(pd.concat(held), keys, size)

    part = src.mapInPandas(local, schema).withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(fan_in)).cast("int"))
    once = lambda rows: _merged(rows, keys, size)
    if not keys:
        part = part.withColumn("_all", F.lit(0))
        first = part.groupBy("_all", "_part").applyInPandas(lambda r: _merged(r[_COLUMNS], [], size), DIGEST)
        return first.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(lambda r: _merged(r[_COLUMNS], [], size), DIGEST)
    first = part.groupBy(*keys, "_part").applyInPandas(lambda r: once(r.drop(columns="_part")), schema)
    done = first.groupBy(*keys).applyInPandas(once, schema)
    return done.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], *_COLUMNS)


def _merged(rows: pd.DataFrame, keys: list[str], size: int) -> pd.DataFrame:
    if not keys:
        return pd.DataFrame([merge(rows, size)], columns=_COLUMNS)
    out = []
    for g, part in rows.groupby(keys, dropna=False, sort=False):
        g = g if isinstance(g, tuple) else (g,)
        g = tuple(None if (isinstance(x, float) and np.isnan(x)) or x is None else x for x in g)
        out.append((*g, *merge(part, size)))
    return pd.DataFrame(out, columns=[*keys, *_COLUMNS])


def merge_digests(d: DataFrame, groups: list[str], size: int = 400) -> DataFrame:
    """Digests of parts or days combined into one per group."""
    fields = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    schema = ", ".join([f"`{g}` {fields[g]}" for g in groups] + [DIGEST])
    return d.select(*groups, *_COLUMNS).groupBy(*groups).applyInPandas(lambda r: _merged(r, groups, size), schema)


def estimates(d: DataFrame, groups: list[str], at: list[float]) -> DataFrame:
    """(groups, n, p, estimate) of digests."""
    fields = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    schema = ", ".join([f"`{g}` {fields[g]}" for g in groups] + ["n long, p double, estimate double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*[r[g] for g in groups], r["n"], p, e) for r in b.to_dict("records") for p, e in zip(at, quantiles(*[r[c] for c in _COLUMNS], at))]
            yield pd.DataFrame(rows, columns=[*groups, "n", "p", "estimate"])

    return d.select(*groups, *_COLUMNS).mapInPandas(run, schema)


def certified_percentiles(df: DataFrame, groups: list[str], value: str, at: list[float], size: int = 400, most_groups: int = 100_000) -> DataFrame:
    """(groups, n, p, estimate, below, upto, rank_error): the digests' estimates and, by a second pass that counts
    the values under and up to each estimate, how far the rank ceil(p * n) is from the estimate's ranks, as a share
    of n. 0 means that the estimate is the exact percentile. Nulls in groups are a group.

    The counting pass reads the rows again beside the few estimates of their group and adds up within tasks: what is
    shuffled is a row a group and task. With up to most_groups groups their estimates are broadcast (their number is
    counted, not assumed); with more they join by group."""
    d = digests(df, groups, value, size)
    e = estimates(d, groups, at).groupBy(*groups).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("p", "estimate"))).alias("_e"))
    e = bounded(e.withColumnsRenamed({g: f"_k{i}" for i, g in enumerate(groups)}), most_groups)
    x = F.col("_x")
    rows = df.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col(value).cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan("_x"))
    on = [F.col(f"_g{i}").eqNullSafe(F.col(f"_k{i}")) for i in range(len(groups))]
    joined = rows.join(e, on) if groups else rows.join(e)  # without groups: one row
    sums = [F.count_if(x < F.col("_e")[i]["estimate"]).alias(f"_b{i}") for i in range(len(at))]
    sums += [F.count_if(x <= F.col("_e")[i]["estimate"]).alias(f"_u{i}") for i in range(len(at))]
    keys = [f"_k{i}" for i in range(len(groups))]
    counted = joined.groupBy(*keys).agg(F.first("n").alias("n"), F.first("_e").alias("_e"), *sums)
    each = F.explode(F.array(*[F.struct(F.col("_e")[i]["p"].alias("p"), F.col("_e")[i]["estimate"].alias("estimate"), F.col(f"_b{i}").alias("below"), F.col(f"_u{i}").alias("upto")) for i in range(len(at))])).alias("_r")
    out = counted.where(F.col("n").isNotNull()).select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], "n", each).select(*groups, "n", "_r.*")
    rank = F.greatest(F.ceil(F.col("p") * F.col("n") - 1e-9), F.lit(1))
    off = F.greatest(F.col("below") + 1 - rank, rank - F.col("upto"), F.lit(0))
    return out.withColumn("rank_error", off / F.col("n"))
