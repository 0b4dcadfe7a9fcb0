"""What a service asks of the scored rows: filtered lists with totals, lookups, bulk points, labelled clusters, KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galena.functions import numeric, text
from galena.operators import relational as rel

# The regions of the public code of places with their departments.
REGIONS = {
    "11": "75 77 78 91 92 93 94 95",
    "24": "18 28 36 37 41 45",
    "27": "21 25 39 58 70 71 89 90",
    "28": "14 27 50 61 76",
    "32": "02 59 60 62 80",
    "44": "08 10 51 52 54 55 57 67 68 88",
    "52": "44 49 53 72 85",
    "53": "22 29 35 56",
    "75": "16 17 19 23 24 33 40 47 64 79 86 87",
    "76": "09 11 12 30 31 32 34 46 48 65 66 81 82",
    "84": "01 03 07 15 26 38 42 43 63 69 73 74",
    "93": "04 05 06 13 83 84",
    "94": "2A 2B 20",
    "01": "971",
    "02": "972",
    "03": "973",
    "04": "974",
    "06": "976",
}
#: The tables a KPI may be read from, by the name it is asked for.
KPIS = ("kpi_marche", "kpi_couverture")


class UnknownKpi(KeyError):
    """A KPI that isn't served."""


def departments(region: str) -> list[str]:
    """The departments of a region's code; none for an unknown code."""
    return REGIONS.get(region, "").split()


def listed(df: DataFrame, condition: Column, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of the rows that meet a condition, each with the total of all that do, in the column total. Order must
    end in a unique column. The total is one count over the same filtered scan; a page beyond the end is empty."""
    found = df.where(condition)
    return rel.page(found, order, limit, offset).withColumn("total", F.lit(found.count()))


def not_excluded(flag: Column) -> Column:
    """True unless the flag is true; an unknown flag excludes nothing."""
    return ~F.coalesce(flag, F.lit(False))


def lookup(df: DataFrame, key: str, asked: list[str], columns: list[str]) -> DataFrame:
    """(key, found, columns) of each asked key, one row each: keys that the table lacks are there with found false.
    Of several rows of a key the least by the columns in order."""
    hits = rel.best_per_key(df.where(F.col(key).isin(asked)), [key], [F.col(c).asc_nulls_last() for c in columns]).withColumn("found", F.lit(True))
    want = df.sparkSession.createDataFrame([(a,) for a in dict.fromkeys(asked)], f"{key} string")
    return want.join(hits.select(key, "found", *columns), key, "left").select(key, F.coalesce("found", F.lit(False)).alias("found"), *columns)


def five_digits(degrees: Column) -> Column:
    """A coordinate to about a metre."""
    return F.round(degrees * 1e5) / 1e5


def bulk_points(df: DataFrame, key: str, most: int = 400_000) -> DataFrame:
    """(key, lon, lat) of the placed rows for a map, rounded to five digits, at most `most` by key."""
    placed = df.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    return placed.select(key, five_digits(F.col("longitude")).alias("lon"), five_digits(F.col("latitude")).alias("lat")).orderBy(key, "lon", "lat").limit(most)


def labelled_clusters(df: DataFrame, zoom: int) -> DataFrame:
    """Clusters of several points with a count label, and single points with their key, of a zoom's grid."""
    one = F.col("n") == 1
    return rel.clusters(df, zoom).select("cx", "cy", "n", "lat", "lon", F.when(one, F.col("siren")).alias("siren"), F.when(~one, text.count_label(F.col("n"))).alias("libelle"))


def kpi(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A KPI's table by its name; UnknownKpi if it isn't one of KPIS or has no table."""
    if name not in KPIS or name not in tables:
        raise UnknownKpi(name)
    return tables[name]


def feature(geometry: tuple[Column, Column], properties: list[Column]) -> Column:
    """A GeoJSON feature of a point (lon, lat); null properties are left out."""
    g = F.struct(F.lit("Point").alias("type"), F.array(*geometry).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), g.alias("geometry"), F.struct(*properties).alias("properties")))


def network_size(n: Column, full: int = 10) -> Column:
    """0 for one site, growing with the logarithm of their number to 1 at `full`; null counts as one."""
    return F.least(F.lit(1.0), F.log1p(F.greatest(F.coalesce(n, F.lit(1)) - 1, F.lit(0)).cast("double")) / F.log1p(F.lit(float(full - 1))))


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a point lies in (west, south, east, north); null coordinates do not."""
    return F.coalesce(lon.between(box[0], box[2]) & lat.between(box[1], box[3]), F.lit(False))


def placed_from_plane(x: Column, y: Column, commune: Column, zones: dict[str, int], boxes: dict[str, tuple[float, float, float, float]], mainland: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """(latitude, longitude) of plane coordinates: the projection by the first three signs of the commune's code (zones:
    code -> EPSG number), Lambert-93 elsewhere; null outside the territory's box and for zero or null coordinates."""
    lat, lon = numeric.lambert93_latitude(x, y), numeric.lambert93_longitude(x, y)
    inside = in_box(lon, lat, mainland)
    for prefix, epsg in zones.items():
        here = F.substring(commune, 1, 3) == prefix
        a, o = numeric.utm_latitude(x, y, epsg), numeric.utm_longitude(x, y, epsg)
        inside = F.when(here, in_box(o, a, boxes[prefix])).otherwise(inside)
        lat, lon = F.when(here, a).otherwise(lat), F.when(here, o).otherwise(lon)
    ok = x.isNotNull() & y.isNotNull() & (x != 0) & (y != 0) & inside
    return F.when(ok, lat), F.when(ok, lon)
