"""Filling fixed-capacity containers with items of varying length."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galena.session import materialize


def pack(kinds: np.ndarray, counts: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Packs items of a few kinds into containers. kinds: (k, 3) whole-number demands of each kind (tokens, segments,
    loss-bearing tokens); counts: items of each kind; limits: (3,). Returns (kind of each item in order of placing,
    its container, number of containers).

    Dot-product heuristic, container by container: of the kinds that still fit, the next is the one whose demand,
    in shares of the limits, has the largest inner product with the room that is left. As many of it as fit are
    placed in one step while no other kind would overtake it."""
    share = kinds / limits
    left = counts.astype(np.int64).copy()
    kind_of, bin_of, b = [], [], 0
    order = np.argsort(-share.sum(1), kind="stable")
    kinds, share, left = kinds[order], share[order], left[order]
    alive = np.flatnonzero(left)
    while len(alive):
        room = limits.astype(np.int64).copy()
        k, s = kinds[alive], share[alive]
        open_ = np.ones(len(alive), bool)
        while True:
            open_ &= (k <= room).all(1) & (left[alive] > 0)
            at = np.flatnonzero(open_)
            if not len(at):
                break
            best = at[np.argmax(s[at] @ (room / limits))]
            kind_of.append(order[alive[best]])
            bin_of.append(b)
            left[alive[best]] -= 1
            room -= k[best]
        b += 1
        if b % 16 == 0 or not left[alive].any():
            alive = alive[left[alive] > 0]
    return np.array(kind_of, np.int64), np.array(bin_of, np.int64), b


def _pack_group(g: pd.DataFrame, limits: np.ndarray) -> pd.DataFrame:
    demand = np.stack([g["size"].to_numpy(), np.ones(len(g), np.int64), g["loss"].to_numpy()], axis=1)
    kinds, which, counts = np.unique(demand, axis=0, return_inverse=True, return_counts=True)
    kind_of, bin_of, _ = pack(kinds, counts, limits)
    # the n-th item of a kind gets the n-th container given to the kind
    items, given = np.argsort(which, kind="stable"), np.argsort(kind_of, kind="stable")
    out = np.empty(len(g), np.int64)
    out[items] = bin_of[given]
    return g.assign(bin=out)


def fill_containers(df: DataFrame, key: str, size: str, capacity: int, loss: Column | None = None, most_segments: int = 512, most_loss: int | None = None, group_items: int = 20_000) -> DataFrame:
    """(key, piece, size, container): the container of each item, or of each piece of an item that is longer than
    the capacity (piece counts from 0; full pieces first, one container each, the rest is packed like an item).

    A container holds at most capacity tokens, most_segments items or pieces and most_loss loss-bearing tokens (by
    default as many as tokens). loss: the loss-bearing tokens of an item, at most its size; by default all tokens of
    a piece but its first, which nothing predicts. A piece bears a share of its item's loss in proportion, rounded
    down. An item whose loss alone is over most_loss gets a container of its own.

    Items are spread at random (by a hash of the key) over groups of about group_items, packed independently, so
    that no task sees more; each group wastes at most about one container. Within a group equal items are one kind,
    so the work grows with the kinds and containers, not with pairs. Container ids are '<group>-<number>'. Items of
    size 0 take a segment and no room; null sizes count as 0. Repeated keys are items of their own. Empty table: no
    rows. Negative sizes count as 0."""
    n = F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0))
    limit_loss = most_loss if most_loss is not None else capacity
    items = df.select(F.col(key).alias("_key"), n.alias("_n"), (F.lit(None).cast("long") if loss is None else F.least(F.greatest(F.coalesce(loss.cast("long"), F.lit(0)), F.lit(0)), n)).alias("_loss"))
    last = F.greatest(F.ceil(F.col("_n") / capacity).cast("long") - 1, F.lit(0))
    pieces = items.select("_key", "_n", "_loss", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    own = F.least(F.lit(capacity).cast("long"), F.col("_n") - F.col("piece") * capacity)
    bears = F.when(F.col("_loss").isNull(), F.greatest(own - 1, F.lit(0))).otherwise(F.floor(F.try_divide(F.col("_loss") * own, F.col("_n"))))
    pieces = pieces.select("_key", "piece", own.alias("size"), F.coalesce(bears, F.lit(0)).cast("long").alias("loss"))
    pieces = materialize(pieces, "pieces")  # narrow rows; the sizes are costly to compute twice
    total = pieces.count()
    groups = max(1, -(-total // group_items))
    pieces = pieces.withColumn("g", F.pmod(F.xxhash64("_key", "piece", F.lit("group")), F.lit(groups)).cast("int"))
    limits = np.array([capacity, most_segments, limit_loss], np.int64)
    kind = df.schema[key].dataType.simpleString()

    def run(g: pd.DataFrame) -> pd.DataFrame:
        whole = ((g["size"] >= capacity) | (g["loss"] > limit_loss)).to_numpy()
        packed = _pack_group(g[~whole], limits)
        first = int(packed["bin"].max()) + 1 if len(packed) else 0
        out = pd.concat([packed, g[whole].assign(bin=np.arange(first, first + int(whole.sum())))])
        return pd.DataFrame({"_key": out["_key"], "piece": out["piece"], "size": out["size"], "container": out["g"].astype(str) + "-" + out["bin"].astype(int).astype(str)})

    # a partition a group or so: the packing is work for a task, however few bytes a group has
    return pieces.repartition(groups, "g").groupBy("g").applyInPandas(run, f"_key {kind}, piece long, size long, container string").select(F.col("_key").alias(key), "piece", F.col("size"), "container")
