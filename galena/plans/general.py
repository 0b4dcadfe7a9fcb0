"""Queries of the general problems: near points, snapshot changes, nested records, repeated messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galena.operators.messages import surplus_messages
from galena.operators.nearby import containing_regions, near_pairs
from galena.operators.nested import Node, flatten
from galena.operators.snapshots import snapshot_changes
from galena.sources.tables import table

OFFER_NODES = (Node("lieu", "lieuTravail"), Node("salaire", "salaire", (Node("complement", "listeComplements"),)))
EVENT_NODES = (Node("evenement", "", (Node("piece", "pieces"),)),)
#: The same with the court of an event, an object of its own.
EVENT_TABLES = (Node("evenement", "", (Node("piece", "pieces"), Node("tribunal", "tribunal"))),)
OFFICER_NODES = (Node("dirigeant", "", (Node("representant", "representants"),)),)
#: Fields of the objects, whatever their table.
FIELDS = "libelle code latitude longitude commune codePostal commentaire type date detail url nb_pages ville numero nom qualite".split()
COORDINATES = {"latitude": 1e-6, "longitude": 1e-6}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    firms = table(spark, d, "cabinet")
    latest = firms.agg(F.max("data_version")).first()[0]
    return near_pairs(table(spark, d, "offre_emploi"), firms.where(F.col("data_version") == latest), 200.0, "offre_id", "siret")


def p1_regions(spark: SparkSession, d: str) -> DataFrame:
    """Each offer with the departments of the register in whose box (of the sites of its latest version) it lies."""
    firms = table(spark, d, "cabinet")
    latest = firms.agg(F.max("data_version")).first()[0]
    la, lo = F.col("latitude"), F.col("longitude")
    sites = firms.where((F.col("data_version") == latest) & la.isNotNull() & lo.isNotNull() & ~((la == 0) & (lo == 0)) & F.col("departement").isNotNull())
    box = sites.groupBy("departement").agg(F.min(la).alias("s"), F.max(la).alias("n"), F.min(lo).alias("w"), F.max(lo).alias("e"))
    corner = lambda a, o: F.struct(F.col(a).alias("lat"), F.col(o).alias("lon"))
    rings = box.select("departement", F.array(corner("s", "w"), corner("s", "e"), corner("n", "e"), corner("n", "w")).alias("ring"))
    return containing_regions(table(spark, d, "offre_emploi"), rings, "offre_id", "departement")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "cabinet"), "siret", "data_version", COORDINATES).select("data_version", "siret", F.col("change").alias("changement"))


def p2_fields(spark: SparkSession, d: str) -> DataFrame:
    """The changed columns of each changed establishment, one row each."""
    return snapshot_changes(table(spark, d, "cabinet"), "siret", "data_version", COORDINATES).select("data_version", "siret", F.explode("fields").alias("champ"))


def _nodes(spark: SparkSession, d: str, values: bool, events: tuple[Node, ...] = EVENT_NODES) -> DataFrame:
    offers, firms, officers = table(spark, d, "offre_brute"), table(spark, d, "enrichissement"), table(spark, d, "recherche_entreprises")
    message = F.concat_ws(":", "kafka_partition", "kafka_offset")
    return flatten(offers, message, F.col("json"), OFFER_NODES, values).unionByName(flatten(firms, F.col("siren"), F.col("bodacc_evenements"), events, values)).unionByName(flatten(officers, F.col("siren"), F.col("dirigeants"), OFFICER_NODES, values))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d, False).select("relation", "parent_id", "parent_pos", "pos")


def p3_tables(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables with the fields of their objects and the link to the parent's label; autres: the fields that have
    no column and are no table of their own, as a JSON text, null if there are none."""
    n = _nodes(spark, d, True, EVENT_TABLES)
    m = F.from_json("value", "map<string,string>")
    inner = sorted(c.field for node in (*OFFER_NODES, *EVENT_TABLES, *OFFICER_NODES) for c in node.nested)
    others = F.map_filter(m, lambda k, v: ~k.isin(*FIELDS, *inner) & v.isNotNull())
    dotted = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ".")
    return n.select("relation", "parent_id", dotted(F.col("label")).alias("label"), dotted(F.slice("label", F.lit(1), F.size("label") - 1)).alias("parent_label"), *[m[c].alias(c) for c in FIELDS], F.when(F.size(others) > 0, F.to_json(others)).alias("autres"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return surplus_messages(table(spark, d, "offre_brute"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_regions, p2_found, p2_fields, p3_found, p3_tables, p7_found)}
_PLACE = "latitude is not null and longitude is not null and not (latitude = 0 and longitude = 0)"
_METRES = "2 * 6371000e0 * asin(sqrt(pow(sin(radians(c.latitude - o.latitude) / 2), 2) + cos(radians(o.latitude)) * cos(radians(c.latitude)) * pow(sin(radians(c.longitude - o.longitude) / 2), 2)))"
_OTHERS = (
    "siren est_siege raison_sociale segment code_ape categorie_juridique forme_juridique date_creation anciennete_annees tranche_effectif est_ess adresse complement_adresse "
    "code_postal commune code_commune departement enseigne x_lambert93 y_lambert93 ban_id est_diffusible"
).split()
_CHANGED = " or ".join([f"a.{c} is distinct from b.{c}" for c in _OTHERS] + [f"coalesce(abs(a.{c} - b.{c}) > 1e-6, (a.{c} is null) <> (b.{c} is null))" for c in COORDINATES])
_VERSIONS = "with d as (select distinct * from cabinet), v as (select data_version as v, lag(data_version) over (order by data_version) as w from (select distinct data_version from cabinet)), a as (select d.*, w from d join v on data_version = v where w is not null), b as (select d.*, v from d join v on data_version = w)"

SQL: dict[str, str] = {
    "p1_found": f"with o as (select distinct offre_id, latitude, longitude from offre_emploi where offre_id is not null and {_PLACE}), c as (select distinct siret, latitude, longitude from cabinet where siret is not null and data_version = (select max(data_version) from cabinet) and {_PLACE}) select distinct offre_id, siret from o join c on abs(c.latitude - o.latitude) < 2e-3 and abs(c.longitude - o.longitude) * cos(radians(o.latitude)) < 2e-3 where {_METRES} <= 200",
    "p1_regions": f"with b as (select departement, min(latitude) as s, max(latitude) as n, min(longitude) as w, max(longitude) as e from cabinet where data_version = (select max(data_version) from cabinet) and {_PLACE} and departement is not null group by departement), o as (select distinct offre_id, latitude, longitude from offre_emploi where offre_id is not null and {_PLACE}) select distinct offre_id, departement from o join b on latitude >= s and latitude < n and longitude >= w and longitude < e",
    "p2_found": f"{_VERSIONS} select data_version, siret, 'ajout' as changement from a where not exists (select 1 from b where b.v = a.data_version and b.siret = a.siret) union select v, siret, 'retrait' from b where not exists (select 1 from a where b.v = a.data_version and b.siret = a.siret) union select a.data_version, a.siret, 'modification' from a join b on b.v = a.data_version and b.siret = a.siret where {_CHANGED}",
    "p2_fields": f"{_VERSIONS}, m as (select a.data_version, a.siret, unnest([{', '.join([f"case when a.{c} is distinct from b.{c} then '{c}' end" for c in _OTHERS] + [f"case when coalesce(abs(a.{c} - b.{c}) > 1e-6, (a.{c} is null) <> (b.{c} is null)) then '{c}' end" for c in COORDINATES])}]) as champ from a join b on b.v = a.data_version and b.siret = a.siret) select * from m where champ is not null",
    "p7_found": "select kafka_partition, kafka_offset, ingest_date from (select *, lower(regexp_replace(coalesce(offre_id, case when json_valid(json) then json_extract_string(json, '$.id') end), '^\\s+|\\s+$', '', 'g')) as id from offre_brute) where id is not null qualify row_number() over (partition by id order by kafka_ts desc nulls last, ingest_date nulls last, kafka_partition, kafka_offset) > 1",
}
