"""Queries of the problems of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galena.llm import digests, entities, packing, residue, spelling, tokens
from galena.sources.tables import table

PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
RANK_BOUND = 0.01
CONTAINER = 2048


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return digests.certified_percentiles(table(spark, d, "leads_scored"), ["segment"], "ca", PERCENTILES)


def p4_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Per segment the number of values and of percentiles whose counted rank error is within the bound: all of them."""
    r = p4_percentiles(spark, d).where(F.col("rank_error") <= RANK_BOUND)
    return r.groupBy("segment").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("within"))


def p4_days(spark: SparkSession, d: str) -> DataFrame:
    """Digests of separate days and their combination hold the same rows and ends as the values themselves: per segment
    the number of values, the least and the greatest, from the merged digests."""
    days = digests.digests(table(spark, d, "leads_scored"), ["segment", "run_date"], "ca")
    return digests.merge_digests(days, ["segment"]).select("segment", "n", F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"))


def p4_combined(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the separate run_date values, combined: the same percentiles without reading the rows again."""
    days = digests.digests(table(spark, d, "leads_scored"), ["segment", "run_date"], "ca")
    return digests.estimates(digests.merge_digests(days, ["segment"]), ["segment"], PERCENTILES)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_matches(spark, d).select("offre_id", "siren")


def p5_matches(spark: SparkSession, d: str) -> DataFrame:
    """The same with the calibrated probability of each match."""
    return entities.match_entities(table(spark, d, "offre_emploi"), table(spark, d, "cabinet"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return spelling.variant_pairs(table(spark, d, "nom_saisi"), "nom_id", "nom", "code_commune", F.col("champ").isin("raison_sociale", "enseigne"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_containers(tokens.token_counts(table(spark, d, "documents")), "doc_id", "n_tokens", CONTAINER)


def p9_limited(spark: SparkSession, d: str) -> DataFrame:
    """Containers under three limits that all bind: tokens, at most 8 pieces, and at most 1,500 loss-bearing tokens
    where three quarters of every other document's tokens bear a loss."""
    sizes = tokens.token_counts(table(spark, d, "documents"))
    loss = F.when(F.col("doc_id") % 2 == 0, F.col("n_tokens")).otherwise(F.floor(F.col("n_tokens") * 0.75))
    return packing.fill_containers(sizes, "doc_id", "n_tokens", CONTAINER, loss=loss, most_segments=8, most_loss=1500)


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """What p9_containers keeps to and how full its containers are, in one row of facts."""
    p = p9_containers(spark, d)
    c = p.groupBy("container").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("segments"), F.sum(F.greatest(F.col("size") - 1, F.lit(0))).alias("loss"))
    facts = c.agg(F.max("tokens").alias("t"), F.max("segments").alias("s"), F.max("loss").alias("l"), F.sum("tokens").alias("all"), F.count(F.lit(1)).alias("n"))
    want = tokens.token_counts(table(spark, d, "documents")).agg(F.sum("n_tokens").alias("want"))
    least = F.ceil(F.col("all") / CONTAINER)
    j = facts.withColumn("k", F.lit(0)).join(want.withColumn("k", F.lit(0)), "k")
    return j.select((F.col("t") <= CONTAINER).alias("within_tokens"), (F.col("s") <= 512).alias("within_segments"), (F.col("l") <= CONTAINER).alias("within_loss"), (F.col("all") == F.col("want")).alias("all_placed"), (F.col("n") <= F.ceil(least * 1.01) + 1).alias("well_filled"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents"), group="siren").select("doc_id")


def p10_windows(spark: SparkSession, d: str) -> DataFrame:
    """The best window of each document with residue and the share of the text that is residue."""
    return residue.residue(table(spark, d, "documents"), group="siren")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p4_percentiles, p4_bounds, p4_combined, p4_days, p5_found, p5_matches, p6_found, p8_ids, p9_containers, p9_limited, p9_fill, p10_found, p10_windows)}

SQL: dict[str, str] = {
    "p4_days": "select segment, count(ca) as n, min(ca) as low, max(ca) as high from leads_scored group by segment having count(ca) > 0",
    "p9_fill": "select true as within_tokens, true as within_segments, true as within_loss, true as all_placed, true as well_filled",
    "p4_bounds": f"select segment, count(ca) as n, {len(PERCENTILES)} as within from leads_scored group by segment having count(ca) > 0",
}
