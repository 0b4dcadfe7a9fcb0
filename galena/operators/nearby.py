"""Points near other points: a range join on space-filling-curve codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galena.functions import numeric, sphere
from galena.session import bounded

_ROW = "bucket long, side int, code long, last long, id string, lat double, lon double"


def _placed(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """Distinct (id, lat, lon) of the rows with a place."""
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    known = la.isNotNull() & lo.isNotNull() & ~F.isnan(la) & ~F.isnan(lo) & ~((la == 0) & (lo == 0)) & F.col(key).isNotNull()
    return df.where(known).select(F.col(key).cast("string").alias("id"), la.alias("lat"), lo.alias("lon")).distinct()


def near_pairs(queries: DataFrame, points: DataFrame, radius_m: float, query_key: str, point_key: str, query_place: tuple[str, str] = ("latitude", "longitude"), point_place: tuple[str, str] = ("latitude", "longitude"), names: tuple[str, str] | None = None, bucket_level: int = 8, most_points: int = 50_000, most_ranges: int = 200_000, distance: str | None = None) -> DataFrame:
    """Each query location with each point at a great-circle distance of at most radius_m, once.

    Points get a curve code, the disc around a query is covered with ranges of codes, and both are brought together
    by the coarse cell (bucket_level) that the range lies in. Within it they are sorted by code, so that each range is
    two binary searches; the distance decides in the end. A cell with more than most_points points or most_ranges
    ranges is split into a grid of slices, each pair of slices one group: no cell has to fit one task, however many
    rows it has, and nothing is dropped. Ranges stream past the sorted points in batches, so that a task holds at most
    most_points points (about) and one batch of pairs.

    Null, NaN or (0, 0) coordinates and null keys: no place, no pair. Repeated rows count once; a key with several
    places is near what any of its places is near. Empty input: no rows. Other columns of the input are ignored.
    distance: adds the smallest distance in metres under this name."""
    q, p = _placed(queries, query_key, *query_place), _placed(points, point_key, *point_place)
    names = names or (query_key, point_key)
    level = max(sphere.cover_level(radius_m), 1)
    bucket_level = min(bucket_level, level)
    down = 3 * (sphere.BITS - bucket_level)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            code = sphere.point_codes(b["lat"].to_numpy(), b["lon"].to_numpy())
            yield pd.DataFrame({"bucket": code >> down, "side": 0, "code": code, "last": code, "id": b["id"], "lat": b["lat"], "lon": b["lon"]})

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            i, lo, hi = sphere.cover_discs(b["lat"].to_numpy(), b["lon"].to_numpy(), radius_m, level, bucket_level)
            t = b.take(i)
            yield pd.DataFrame({"bucket": lo >> down, "side": 1, "code": lo, "last": hi, "id": t["id"].to_numpy(), "lat": t["lat"].to_numpy(), "lon": t["lon"].to_numpy()})

    rows = p.mapInPandas(encode, _ROW).unionByName(q.mapInPandas(cover, _ROW))
    # cells over the limit are at most rows / limit many: broadcast if they are few, else joined like any table
    size = rows.groupBy("bucket").agg(F.count_if(F.col("side") == 0).alias("np"), F.count_if(F.col("side") == 1).alias("nq"))
    hot = size.where((F.col("np") > most_points) | (F.col("nq") > most_ranges)).select("bucket", F.ceil(F.greatest(F.col("np"), F.lit(1)) / most_points).cast("int").alias("sp"), F.ceil(F.greatest(F.col("nq"), F.lit(1)) / most_ranges).cast("int").alias("sq"))
    rows = rows.join(bounded(hot), "bucket", "left")
    sp, sq = F.coalesce("sp", F.lit(1)), F.coalesce("sq", F.lit(1))
    mine = F.pmod(F.xxhash64("id", "code"), F.when(F.col("side") == 0, sp).otherwise(sq)).cast("int")
    slices = F.when(F.col("side") == 0, F.transform(F.sequence(F.lit(0), sq - 1), lambda j: mine * sq + j)).otherwise(F.transform(F.sequence(F.lit(0), sp - 1), lambda i: i * sq + mine))
    rows = rows.select("bucket", F.explode(slices).alias("slice"), "side", "code", "last", "id", "lat", "lon")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held, codes, ids, lats, lons = None, [], None, None, None, None
        for b in batches:
            cuts = np.flatnonzero(np.diff(b["bucket"].to_numpy()) | np.diff(b["slice"].to_numpy()) | np.diff(b["side"].to_numpy())) + 1
            for a, z in zip([0, *cuts], [*cuts, len(b)]):
                if a == z:
                    continue
                part = b.iloc[a:z]
                at = (part["bucket"].iat[0], part["slice"].iat[0])
                if at != group:
                    group, held, codes = at, [], None
                if part["side"].iat[0] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if codes is None:
                    pts = pd.concat(held) if len(held) > 1 else held[0]
                    codes, ids, lats, lons = (pts[c].to_numpy() for c in ("code", "id", "lat", "lon"))
                first = np.searchsorted(codes, part["code"].to_numpy(), "left")
                many = np.searchsorted(codes, part["last"].to_numpy(), "right") - first
                qi, qa, qo = (part[c].to_numpy() for c in ("id", "lat", "lon"))
                rest = np.flatnonzero(many)
                while len(rest):  # about a million candidates at once
                    k = max(1, int(np.searchsorted(np.cumsum(many[rest]), 1_000_000, "right")))
                    now, rest = rest[:k], rest[k:]
                    total = int(many[now].sum())
                    left = np.repeat(now, many[now])
                    right = np.arange(total) - np.repeat(np.cumsum(many[now]) - many[now], many[now]) + first[left]
                    d = sphere.haversine_m(qa[left], qo[left], lats[right], lons[right])
                    ok = d <= radius_m
                    if ok.any():
                        yield pd.DataFrame({names[0]: qi[left[ok]], names[1]: ids[right[ok]], "_m": d[ok]})

    found = rows.repartition("bucket", "slice").sortWithinPartitions("bucket", "slice", "side", "code").mapInPandas(match, f"`{names[0]}` string, `{names[1]}` string, _m double")
    return found.groupBy(*names).agg(F.min("_m").alias(distance)) if distance else found.select(*names).distinct()


def _inside(lat: Column, lon: Column, ring: Column) -> Column:
    """Whether a point lies in a ring (array<struct<lat, lon>>, closed or not), by the parity of the edges that a ray to
    the east crosses; edges are straight in degrees. A point on a western or southern edge is inside, on the others not."""
    n = F.size(ring)

    def crossed(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1))
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        at = a["lon"] + (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) * (b["lon"] - a["lon"])
        return F.when(spans & (lon < at), 1).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), crossed), F.lit(0), lambda s, x: s + x) % 2 == 1


def _part_of(name: str):
    return lambda corner: corner[name]


def containing_regions(points: DataFrame, regions: DataFrame, point_key: str, region_key: str, ring: str = "ring", place: tuple[str, str] = ("latitude", "longitude")) -> DataFrame:
    """(point_key, region_key): each point with the regions that contain it, once.

    regions: one ring a row (array<struct<lat: double, lon: double>>), several rows of a key together are its parts.
    Each ring lies in a disc around the middle of its box; rings go by the size of that disc, in powers of two metres (some
    twenty classes at most), and each class is covered with ranges of curve codes and joined like near_pairs; the ring
    itself decides. Rings of fewer than three corners, or with a null one, contain nothing; rings may not cross the
    date line. Points without a place are in no region; repeated rows count once; empty tables give no rows."""
    r = regions.where(F.col(region_key).isNotNull() & (F.size(ring) >= 3) & ~F.exists(ring, lambda c: c["lat"].isNull() | c["lon"].isNull()))
    lats, lons = F.transform(ring, lambda c: c["lat"]), F.transform(ring, lambda c: c["lon"])
    lat, lon = (F.array_max(lats) + F.array_min(lats)) / 2, (F.array_max(lons) + F.array_min(lons)) / 2
    r = r.select(F.col(region_key).cast("string").alias("_region"), F.col(ring).alias("_ring"), F.xxhash64(F.col(region_key).cast("string"), ring).cast("string").alias("_part"), lat.alias("latitude"), lon.alias("longitude"))
    reach = F.array_max(F.transform("_ring", lambda c: numeric.haversine(F.col("latitude"), F.col("longitude"), c["lat"], c["lon"])))
    # a disc through the corners may leave out a bit of a long edge: a tenth more holds it
    r = r.withColumn("_class", F.greatest(F.ceil(F.log2(reach * 1.1 + 1)), F.lit(4)).cast("int"))
    p = points.select(F.col(point_key).cast("string").alias("_point"), F.col(place[0]).cast("double").alias("latitude"), F.col(place[1]).cast("double").alias("longitude")).distinct()
    numbered = p.withColumn("_id", F.xxhash64("_point", "latitude", "longitude").cast("string"))
    out = None
    for c in sorted(x["_class"] for x in r.select("_class").distinct().collect()):  # sizes of regions, not regions
        some = r.where(F.col("_class") == c)
        met = near_pairs(some.withColumn("latitude", F.when((F.col("latitude") == 0) & (F.col("longitude") == 0), 1e-9).otherwise(F.col("latitude"))), numbered, float(2**c), "_part", "_id")
        out = met if out is None else out.unionByName(met)
    if out is None:
        return p.limit(0).select(F.col("_point").alias(point_key), F.lit("").alias(region_key))
    ends = [F.array_min(F.transform("_ring", _part_of(x))).alias(f"_{x}0") for x in ("lat", "lon")] + [F.array_max(F.transform("_ring", _part_of(x))).alias(f"_{x}1") for x in ("lat", "lon")]
    j = out.join(numbered, "_id").join(r.select("_part", "_region", "_ring", *ends), "_part")
    j = j.where(F.col("latitude").between(F.col("_lat0"), F.col("_lat1")) & F.col("longitude").between(F.col("_lon0"), F.col("_lon1")))
    return j.where(_inside(F.col("latitude"), F.col("longitude"), F.col("_ring"))).select(F.col("_point").alias(point_key), F.col("_region").alias(region_key)).distinct()
