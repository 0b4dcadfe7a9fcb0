"""Queries of the engine's own operators over the domain tables, each with the SQL it must equal."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galena.functions import numeric, text
from galena.operators import relational as rel
from galena.operators.nearby import near_pairs
from galena.session import new_path
from galena.sources.tables import table
from galena.streaming import append as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Everything that depends on today takes this day instead.
AS_OF = "2025-06-03"
METIERS = ("paie", "comptabilite", "juridique", "patrimoine", "immobilier")


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


LATEST = "select distinct * from cabinet where data_version = (select max(data_version) from cabinet)"
RUN = "select distinct * from leads_scored where (data_version, run_date) = (select (data_version, run_date) from leads_scored order by data_version desc, run_date desc limit 1)"
OFFERS = "select * from offre_emploi qualify row_number() over (partition by offre_id order by ingest_date desc, kafka_partition, kafka_offset) = 1"


def _rows_once(t: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Repeated rows count once. Whole rows are told apart by a 128-bit print of all columns, so that only that and the
    asked columns are shuffled; without columns, all of them."""
    if not columns:
        return t.distinct()
    asked = dict.fromkeys(columns)
    parts = [x for c, k in t.dtypes for x in ((F.to_json(F.struct(c)) if k.startswith(("array", "struct")) else F.col(c)), F.col(c).isNull())]
    prints = [F.xxhash64(*parts).alias("_f1"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("_f2")]
    return t.select(*asked, *prints).distinct().drop("_f1", "_f2")


def register(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The establishments of the latest version, siret and the columns, each row once."""
    return _rows_once(rel.latest(table(spark, d, "cabinet"), "data_version"), ("siret", *columns) if columns else ())


def run(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The scored firms of the latest run, each row once."""
    return _rows_once(rel.latest(table(spark, d, "leads_scored"), "data_version", "run_date"), ("siren", *columns) if columns else ())


def offers(spark: SparkSession, d: str) -> DataFrame:
    return rel.best_per_key(table(spark, d, "offre_emploi"), ["offre_id"], [F.col("ingest_date").desc(), F.col("kafka_partition"), F.col("kafka_offset")])


# Scans, versions, sentinels


@query(f"select segment, count(*) as n from ({LATEST}) group by segment")
def latest_version_scan(spark, d):
    return register(spark, d, "segment").groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query(f"select siret, nullif(enseigne, '[ND]') as enseigne, nullif(complement_adresse, '[ND]') as complement_adresse, nullif(adresse, '[ND]') as adresse from ({LATEST})")
def nd_nulling(spark, d):
    return rel.nulled(register(spark, d, "enseigne", "complement_adresse", "adresse")).select("siret", "enseigne", "complement_adresse", "adresse")


@query(f"select siret, code_ape from ({LATEST}) where code_ape in ('69.20Z', '69.10Z') and est_siege and tranche_effectif is not null")
def code_filter(spark, d):
    return register(spark, d, "code_ape", "est_siege", "tranche_effectif").where(F.col("code_ape").isin("69.20Z", "69.10Z") & F.col("est_siege") & F.col("tranche_effectif").isNotNull()).select("siret", "code_ape")


@query("select champ, round(part, 9) as part from (select avg((ca is null)::int) as ca, avg((segment is null)::int) as segment, avg((derniere_offre_date is null)::int) as derniere_offre_date from leads_scored) unpivot (part for champ in (ca, segment, derniere_offre_date))")
def null_rates(spark, d):
    return rel.null_rates(table(spark, d, "leads_scored").select("ca", "segment", "derniere_offre_date")).withColumn("part", F.round("part", 9))


@query("select siren, 'x' as absent, nb_dirigeants from enrichissement")
def optional_columns(spark, d):
    t = table(spark, d, "enrichissement")
    return t.select("siren", rel.optional(t, "absent", "string", "x"), rel.optional(t, "nb_dirigeants", "int"))


# Joins


@query(f"with f as (select siren, min(raison_sociale) as nom, min(segment) as segment from ({LATEST}) group by siren) select c.siret, f.nom, r.categorie_entreprise from ({LATEST}) c join f using (siren) left join (select siren, max(categorie_entreprise) as categorie_entreprise from recherche_entreprises group by siren) r using (siren)")
def firm_establishment_join(spark, d):
    c = register(spark, d, "siren", "raison_sociale")
    f = c.groupBy("siren").agg(F.min("raison_sociale").alias("nom"))
    r = table(spark, d, "recherche_entreprises").groupBy("siren").agg(F.max("categorie_entreprise").alias("categorie_entreprise"))
    return c.select("siren", "siret").join(f, "siren").join(r, "siren", "left").select("siret", "nom", "categorie_entreprise")


@query("select distinct siren from cabinet where siren in (select siren from enrichissement)")
def semi_members(spark, d):
    return table(spark, d, "cabinet").select("siren").distinct().join(table(spark, d, "enrichissement").select("siren"), "siren", "left_semi")


@query("select distinct siren from cabinet where siren not in (select siren from recherche_entreprises where siren is not null)")
def resume_anti(spark, d):
    return table(spark, d, "cabinet").select("siren").distinct().join(table(spark, d, "recherche_entreprises").select("siren"), "siren", "left_anti")


@query("""with e as (select siren, max(ca) as ca, max(nb_dirigeants) as nb_dirigeants, max(bodacc_nb_annonces_24m) as annonces from enrichissement group by siren),
r as (select siren, max(ca) as ca, max(nb_dirigeants) as nb_dirigeants, max(nb_etablissements_ouverts) as ouverts from recherche_entreprises group by siren)
select siren, coalesce(e.ca, r.ca) as ca, coalesce(e.nb_dirigeants, r.nb_dirigeants) as nb_dirigeants, annonces, ouverts from e full join r using (siren)""")
def enrichment_full_outer(spark, d):
    e = table(spark, d, "enrichissement").groupBy("siren").agg(F.max("ca").alias("ca"), F.max("nb_dirigeants").alias("nb_dirigeants"), F.max("bodacc_nb_annonces_24m").alias("annonces"))
    r = table(spark, d, "recherche_entreprises").groupBy("siren").agg(F.max("ca").alias("ca"), F.max("nb_dirigeants").alias("nb_dirigeants"), F.max("nb_etablissements_ouverts").alias("ouverts"))
    return rel.merge_by_key([e, r], "siren").select("siren", "ca", "nb_dirigeants", "annonces", "ouverts")


_KM = "2 * 6371000e0 * asin(sqrt(pow(sin(radians(c.latitude - o.latitude) / 2), 2) + cos(radians(o.latitude)) * cos(radians(c.latitude)) * pow(sin(radians(c.longitude - o.longitude) / 2), 2)))"


@query(f"with o as (select offre_id, latitude, longitude from ({OFFERS}) where not (latitude = 0 and longitude = 0)), c as (select siret, latitude, longitude from ({LATEST}) where not (latitude = 0 and longitude = 0)) select offre_id, siret, round({_KM}, 3) as metres from o join c on abs(c.latitude - o.latitude) < 2e-3 and abs(c.longitude - o.longitude) < 3e-3 where {_KM} <= 200")
def grid_join(spark, d):
    here = lambda t: t.where(~((F.col("latitude") == 0) & (F.col("longitude") == 0)))
    o = here(offers(spark, d).select("offre_id", "latitude", "longitude"))
    c = here(register(spark, d, "latitude", "longitude").select("siret", "latitude", "longitude"))
    return near_pairs(o, c, 200.0, "offre_id", "siret", distance="metres").withColumn("metres", F.round("metres", 3))


def _key_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(translate(upper(coalesce({c}, '')), '{text.ACCENTED}', '{text.PLAIN}'), '\\b({'|'.join(text.LEGAL_WORDS)})\\b', ' ', 'g'), '[^A-Z0-9]+', ' ', 'g'))"


@query(f"select distinct entreprise_nom, {_key_sql('entreprise_nom')} as cle from offre_emploi where entreprise_nom is not null")
def norm_name(spark, d):
    return table(spark, d, "offre_emploi").where(F.col("entreprise_nom").isNotNull()).select("entreprise_nom").distinct().select("entreprise_nom", text.company_key(F.col("entreprise_nom")).alias("cle"))


_NAMES = f"with o as (select distinct entreprise_nom, {_key_sql('entreprise_nom')} as k from offre_emploi), f as (select distinct siren, {_key_sql('raison_sociale')} as a, {_key_sql('enseigne')} as b from cabinet)"


@query(f"{_NAMES} select distinct entreprise_nom, siren from o join f on k <> '' and k = a union select distinct entreprise_nom, siren from o join f on k <> '' and k = b")
def name_match(spark, d):
    o = table(spark, d, "offre_emploi").select("entreprise_nom").distinct().select("entreprise_nom", text.company_key(F.col("entreprise_nom")).alias("k"))
    f = table(spark, d, "cabinet").select("siren", text.company_key(F.col("raison_sociale")).alias("a"), text.company_key(F.col("enseigne")).alias("b")).distinct()
    return rel.or_join(o, f, "k", ["a", "b"]).select("entreprise_nom", "siren").distinct()


@query(f"""with o as (select offre_id, code_commune, departement, {_key_sql('entreprise_nom')} as k from ({OFFERS})),
f as (select distinct siren, code_commune as fc, departement as fd, {_key_sql('raison_sociale')} as a from ({LATEST})),
m as (select offre_id, siren, case when max((code_commune = fc)::int) = 1 then 3 when max((departement = fd)::int) = 1 then 2 else 1 end as niveau from o join f on k <> '' and k = a group by offre_id, siren),
b as (select * from m qualify row_number() over (partition by offre_id order by niveau desc, siren) = 1)
select o.offre_id, b.siren, case niveau when 3 then 'nom_commune' when 2 then 'nom_dept' when 1 then 'nom_seul' else 'aucun' end as niveau from o left join b using (offre_id)""")
def resolve_best(spark, d):
    o = offers(spark, d).select("offre_id", "code_commune", "departement", text.company_key(F.col("entreprise_nom")).alias("k"))
    f = register(spark, d, "siren", "code_commune", "departement", "raison_sociale").select("siren", F.col("code_commune").alias("fc"), F.col("departement").alias("fd"), text.company_key(F.col("raison_sociale")).alias("a")).distinct()
    # the best firm of each (name, commune), (name, department) and name is chosen before the join: a name with very
    # many offers or sites then costs one lookup an offer
    best = lambda *keys: f.where(F.col("a") != "").groupBy(*keys).agg(F.min("siren").alias("siren"))
    on = F.col("k") == F.col("a")
    asked = o.where(F.col("k") != "")
    tiers = [asked.join(best("a", "fc"), on & (F.col("code_commune") == F.col("fc"))).select("offre_id", "siren", F.lit(3).alias("n")), asked.join(best("a", "fd"), on & (F.col("departement") == F.col("fd"))).select("offre_id", "siren", F.lit(2).alias("n")), asked.join(best("a"), on).select("offre_id", "siren", F.lit(1).alias("n"))]
    b = tiers[0].unionByName(tiers[1]).unionByName(tiers[2]).groupBy("offre_id").agg(F.max(F.struct("n", "siren")).alias("s")).select("offre_id", "s.siren", "s.n")
    label = F.when(F.col("n") == 3, "nom_commune").when(F.col("n") == 2, "nom_dept").when(F.col("n") == 1, "nom_seul").otherwise("aucun")
    return o.select("offre_id").join(b, "offre_id", "left").select("offre_id", "siren", label.alias("niveau"))


_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda x: x <> ''))"


@query(f"select siren, round(case when len(x) + len(y) - len(list_intersect(x, y)) > 0 then len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y)))::double else 0 end, 6) as j from (select siren, {_WORDS.format('a')} as x, {_WORDS.format('b')} as y from (select distinct siren, {_key_sql('raison_sociale')} as a, {_key_sql('enseigne')} as b from cabinet where enseigne is not null))")
def token_jaccard(spark, d):
    f = table(spark, d, "cabinet").where(F.col("enseigne").isNotNull()).select("siren", text.company_key(F.col("raison_sociale")).alias("a"), text.company_key(F.col("enseigne")).alias("b")).distinct()
    return f.select("siren", F.round(text.jaccard(F.col("a"), F.col("b")), 6).alias("j"))


# Aggregations


@query(f"select siren, count(*) as n from ({LATEST}) group by siren")
def establishment_counts(spark, d):
    return register(spark, d, "siren").groupBy("siren").agg(F.count(F.lit(1)).alias("n"))


@query(f"select departement, segment, count(*) as n from ({LATEST}) group by all")
def zone_counts(spark, d):
    return register(spark, d, "departement", "segment").groupBy("departement", "segment").agg(F.count(F.lit(1)).alias("n"))


@query(f"select code_commune, segment, count(*) as n, round(avg(latitude), 6) as lat, round(avg(longitude), 6) as lon from ({LATEST}) group by all")
def zone_centroids(spark, d):
    return register(spark, d, "code_commune", "segment", "latitude", "longitude").groupBy("code_commune", "segment").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("latitude"), 6).alias("lat"), F.round(F.avg("longitude"), 6).alias("lon"))


@query(f"select departement, count(*) as n90, count(*) filter (where date_creation::date > date '{AS_OF}' - 30) as n30, count(*) filter (where type_contrat = 'CDI') as cdi, cast(sum(coalesce(nombre_postes, 1)) as bigint) as postes, cast(max(date_creation::date) as varchar) as derniere from ({OFFERS}) where date_creation::date between date '{AS_OF}' - 90 and date '{AS_OF}' group by departement")
def windowed_signal(spark, d):
    day, as_of = F.to_date("date_creation"), F.lit(AS_OF).cast("date")
    o = offers(spark, d).where(day.between(F.date_sub(as_of, 90), as_of))
    return o.groupBy("departement").agg(F.count(F.lit(1)).alias("n90"), F.count_if(day > F.date_sub(as_of, 30)).alias("n30"), F.count_if(F.col("type_contrat") == "CDI").alias("cdi"), F.sum(F.coalesce("nombre_postes", F.lit(1))).alias("postes"), F.max(day).cast("string").alias("derniere"))


@query("select departement, " + ", ".join(f"count(*) filter (where metier = '{m}') as {m}" for m in METIERS) + f" from ({OFFERS}) group by departement")
def pivot_counts(spark, d):
    p = offers(spark, d).groupBy("departement").pivot("metier", list(METIERS)).agg(F.count(F.lit(1)))
    return p.select("departement", *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in METIERS])


@query(f"select code_commune, intitule, offre_id from ({OFFERS}) where date_creation is not null qualify row_number() over (partition by code_commune order by date_creation desc, intitule desc nulls last, offre_id desc) = 1")
def argmax_last(spark, d):
    o = offers(spark, d).where(F.col("date_creation").isNotNull())
    return o.groupBy("code_commune").agg(F.max(F.struct("date_creation", "intitule", "offre_id")).alias("s")).select("code_commune", "s.intitule", "s.offre_id")


@query("select departement, array_to_string(list_sort(list(distinct type_contrat)), ',') as types from offre_emploi where type_contrat is not null group by departement")
def collect_types(spark, d):
    return table(spark, d, "offre_emploi").where(F.col("type_contrat").isNotNull()).groupBy("departement").agg(F.array_join(F.sort_array(F.collect_set("type_contrat")), ",").alias("types"))


@query(f"select bande_score, count(*) as n, round(avg(score), 1) as moyenne from ({RUN}) group by bande_score")
def band_summary(spark, d):
    return run(spark, d, "bande_score", "score").groupBy("bande_score").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 1).alias("moyenne"))


@query("select code_rome, count(*) as n from offre_emploi group by code_rome order by n desc, code_rome limit 10")
def value_counts(spark, d):
    return table(spark, d, "offre_emploi").groupBy("code_rome").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("code_rome").asc_nulls_last()).limit(10)


@query("select segment, median(ca) as mediane, count(ca) as n from leads_scored group by segment")
def median_report(spark, d):
    return rel.exact_medians(table(spark, d, "leads_scored"), "segment", "ca").select("segment", F.col("median").alias("mediane"), "n")


@query(f"select cast(sum(flag_ca_hausse::int) as bigint) as hausse, cast(sum((nb_offres_30j > 0)::int) as bigint) as recrute, cast(sum((ca < 0)::int) as bigint) as negatif from ({RUN})")
def flag_report(spark, d):
    return run(spark, d, "flag_ca_hausse", "nb_offres_30j", "ca").agg(*[F.sum(c.cast("int")).alias(n) for c, n in ((F.col("flag_ca_hausse"), "hausse"), (F.col("nb_offres_30j") > 0, "recrute"), (F.col("ca") < 0, "negatif"))])


@query("select code_rome, cast(max(date_creation) as varchar) as repere from offre_emploi group by code_rome")
def high_watermark(spark, d):
    return streaming.high_water_marks(table(spark, d, "offre_emploi"), "code_rome", "date_creation").select("code_rome", F.date_format("mark", "yyyy-MM-dd HH:mm:ss").alias("repere"))


_EVENTS = "select siren, json_extract_string(e, '$.date') as jour, json_extract_string(e, '$.type') as type from (select siren, unnest(json_extract(bodacc_evenements, '$[*]')) as e from (select distinct siren, bodacc_evenements from enrichissement) where case when json_valid(bodacc_evenements) then json_type(bodacc_evenements) = 'ARRAY' else false end) where json_type(e) = 'OBJECT'"


@query(f"select siren, count(*) as n, bool_or(coalesce(type = 'radiation', false)) as radiee, count(*) filter (where jour >= cast(date '{AS_OF}' - 730 as varchar)) as n730, max(jour) as dernier, array_to_string(list_sort(list(coalesce(jour, '') || ' ' || coalesce(type, '')), 'DESC')[1:6], '; ') as six from ({_EVENTS}) group by siren")
def notice_summary(spark, d):
    e = table(spark, d, "enrichissement").select("siren", "bodacc_evenements").distinct().where(F.col("bodacc_evenements").rlike(r"^\s*\["))
    e = e.select("siren", F.explode(F.from_json("bodacc_evenements", "array<string>")).alias("x")).where(F.col("x").startswith("{")).select("siren", F.from_json("x", "date string, type string").alias("e")).select("siren", F.col("e.date").alias("jour"), F.col("e.type").alias("type"))
    floor = F.date_sub(F.lit(AS_OF).cast("date"), 730).cast("string")
    each = F.concat(F.coalesce("jour", F.lit("")), F.lit(" "), F.coalesce("type", F.lit("")))
    return e.groupBy("siren").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.coalesce(F.col("type") == "radiation", F.lit(False))).alias("radiee"), F.count_if(F.col("jour") >= floor).alias("n730"), F.max("jour").alias("dernier"), F.array_join(F.slice(F.sort_array(F.collect_list(each), False), 1, 6), "; ").alias("six"))


# Windows


@query("select offre_id, kafka_partition, kafka_offset, ingest_date from offre_emploi qualify row_number() over (partition by offre_id order by ingest_date desc, kafka_partition, kafka_offset) = 1")
def latest_per_key(spark, d):
    return offers(spark, d).select("offre_id", "kafka_partition", "kafka_offset", "ingest_date")


@query(f"select siren, siret, cast(date_creation as varchar) as date_creation from ({LATEST}) qualify row_number() over (partition by siren order by date_creation desc nulls last, siret) = 1")
def best_with_nulls_last(spark, d):
    return rel.best_per_key(register(spark, d, "siren", "date_creation"), ["siren"], [F.col("date_creation").desc_nulls_last(), F.col("siret")]).select("siren", "siret", F.col("date_creation").cast("string").alias("date_creation"))


@query("with u as (select distinct siren, run_date, ca from leads_scored where ca > 0), r as (select *, row_number() over (partition by siren order by run_date desc, ca desc) as r from u) select siren, max(ca) filter (where r = 1) as dernier, max(ca) filter (where r = 2) as avant from r where r <= 2 group by siren")
def best_and_previous(spark, d):
    u = table(spark, d, "leads_scored").where(F.col("ca") > 0).select("siren", "run_date", "ca").distinct()
    r = u.withColumn("r", F.row_number().over(Window.partitionBy("siren").orderBy(F.col("run_date").desc(), F.col("ca").desc()))).where(F.col("r") <= 2)
    return r.groupBy("siren").agg(F.max(F.when(F.col("r") == 1, F.col("ca"))).alias("dernier"), F.max(F.when(F.col("r") == 2, F.col("ca"))).alias("avant"))


@query(f"select siren, segment, round(percent_rank() over (partition by segment order by greatest(coalesce(ca, 0), 0)), 6) as rang from ({RUN})")
def percent_rank(spark, d):
    t = run(spark, d, "segment", "ca").withColumn("v", F.greatest(F.coalesce("ca", F.lit(0)), F.lit(0)))
    return rel.percent_ranks(t, "segment", "v", "rang").select("siren", "segment", F.round("rang", 6).alias("rang"))


# Scores made of parts (the parts and weights are parameters)

WEIGHTS = {"expert_comptable": (30.0, 25.0, 20.0), "avocat_notaire": (20.0, 30.0, 10.0)}
_PARTS_SQL = f"""select siren, segment, score, recence_jours, nb_offres_30j,
percent_rank() over (partition by segment order by greatest(coalesce(ca, 0), 0)) as taille,
case when date '{AS_OF}' - derniere_offre_date >= 0 then pow(0.5, (date '{AS_OF}' - derniere_offre_date) / 40e0) else 0 end as fraicheur,
least(nb_etablissements / 10e0, 1) as reseau,
case segment when 'expert_comptable' then 30e0 when 'avocat_notaire' then 20e0 else 0e0 end as w1, case segment when 'expert_comptable' then 25e0 when 'avocat_notaire' then 30e0 else 0e0 end as w2, case segment when 'expert_comptable' then 20e0 when 'avocat_notaire' then 10e0 else 0e0 end as w3 from ({RUN})"""


def _scored(spark, d):
    parts = {"taille": F.col("rang"), "fraicheur": numeric.half_life(F.col("derniere_offre_date"), F.lit(AS_OF).cast("date"), 40), "reseau": F.least(F.col("nb_etablissements") / F.lit(10.0), F.lit(1.0))}
    t = run(spark, d, "segment", "ca", "derniere_offre_date", "nb_etablissements").withColumn("v", F.greatest(F.coalesce("ca", F.lit(0)), F.lit(0)))
    t = rel.percent_ranks(t, "segment", "v", "rang").select("siren", "segment", *[v.alias(k) for k, v in parts.items()])
    by_segment = F.create_map(*[x for s, v in WEIGHTS.items() for x in (F.lit(s), F.create_map(*[y for k, z in zip(parts, v) for y in (F.lit(k), F.lit(z))]))])
    score, detail = rel.weighted_score({k: F.col(k) for k in parts}, F.coalesce(F.try_element_at(by_segment, F.coalesce("segment", F.lit(""))), F.create_map().cast("map<string,double>")))
    return t.select("siren", "segment", score.alias("note"), detail.alias("detail"))


@query(f"select siren, cast(least(greatest(round(100 * (w1 * taille + w2 * fraicheur + w3 * coalesce(reseau, 0)) / greatest(w1 + w2 + w3, 1)), 0), 100) as int) as note from ({_PARTS_SQL})")
def weighted_score(spark, d):
    return _scored(spark, d).select("siren", "note")


@query(f"select siren, unnest(['taille', 'fraicheur', 'reseau']) as partie, unnest([round(100 * w1 * taille / greatest(w1 + w2 + w3, 1), 1), round(100 * w2 * fraicheur / greatest(w1 + w2 + w3, 1), 1), round(100 * w3 * coalesce(reseau, 0) / greatest(w1 + w2 + w3, 1), 1)]) as apport from ({_PARTS_SQL})")
def score_detail_long(spark, d):
    return _scored(spark, d).select("siren", F.explode("detail").alias("partie", "apport"))


@query(f"select siren, array_to_string(list_filter([case when nb_offres_30j > 0 then 'recrute' end, case when flag_ca_hausse then 'hausse' end, case when nb_etablissements >= 5 then 'reseau' end, case when ca < 0 then 'negatif' end], lambda x: x is not null), ',') as marques from ({RUN})")
def flags_list(spark, d):
    c = rel.chosen((F.col("nb_offres_30j") > 0, "recrute"), (F.col("flag_ca_hausse"), "hausse"), (F.col("nb_etablissements") >= 5, "reseau"), (F.col("ca") < 0, "negatif"))
    return run(spark, d, "nb_offres_30j", "flag_ca_hausse", "nb_etablissements", "ca").select("siren", F.array_join(c, ",").alias("marques"))


@query(f"select siren, score, recence_jours, nb_offres_30j from ({RUN}) where recence_jours <= 2 order by score desc, recence_jours, nb_offres_30j desc, siren")
def daily_signals(spark, d):
    return run(spark, d, "score", "recence_jours", "nb_offres_30j").where(F.col("recence_jours") <= 2).select("siren", "score", "recence_jours", "nb_offres_30j").orderBy(F.col("score").desc(), "recence_jours", F.col("nb_offres_30j").desc(), "siren")


@query("select distinct siren, ca, ca_n1, round((ca - ca_n1) / abs(ca_n1)::double, 4) as croissance, case when ca_n1 <> 0 and ca is not null then round((ca - ca_n1) / abs(ca_n1)::double, 4) > 0.10 else false end as hausse from (select siren, max(ca) as ca, max(nullif(ca_n1, 0)) as ca_n1 from enrichissement group by siren)")
def growth_flags(spark, d):
    e = table(spark, d, "enrichissement").groupBy("siren").agg(F.max("ca").alias("ca"), F.max(F.nullif(F.col("ca_n1"), F.lit(0))).alias("ca_n1"))
    g = numeric.growth(F.col("ca"), F.col("ca_n1"))
    return e.select("siren", "ca", "ca_n1", g.alias("croissance"), F.coalesce(g > 0.10, F.lit(False)).alias("hausse"))


# Upsert and queues


@query("""with t as (select siren, min(raison_sociale) as nom, min(code_commune) as commune, cast(0 as int) as priorite from cabinet where data_version = (select min(data_version) from cabinet) group by siren),
c as (select siren, min(raison_sociale) as nom, min(code_commune) as commune, max(score) as priorite from leads_scored group by siren)
select siren, coalesce(c.priorite, t.priorite) as priorite, coalesce(t.nom, c.nom) as nom, coalesce(t.commune, c.commune) as commune from t full join c using (siren)""")
def queue_upsert(spark, d):
    c = table(spark, d, "cabinet")
    first = c.agg(F.min("data_version")).first()[0]
    t = c.where(F.col("data_version") == first).groupBy("siren").agg(F.min("raison_sociale").alias("nom"), F.min("code_commune").alias("commune")).withColumn("priorite", F.lit(0))
    new = table(spark, d, "leads_scored").groupBy("siren").agg(F.min("raison_sociale").alias("nom"), F.min("code_commune").alias("commune"), F.max("score").alias("priorite"))
    return rel.upsert(t, new, "siren", ["priorite"], ["nom", "commune"])


@query(f"select siren, score, cast(derniere_offre_date + 30 as varchar) as due from ({RUN}) where derniere_offre_date + 30 <= date '{AS_OF}' order by score desc, siren limit 100")
def queue_due(spark, d):
    due = F.date_add("derniere_offre_date", 30)
    return run(spark, d, "score", "derniere_offre_date").where(due <= F.lit(AS_OF).cast("date")).select("siren", "score", due.cast("string").alias("due")).orderBy(F.col("score").desc(), "siren").limit(100)


# Serving


@query(f"select siren, raison_sociale, score from ({RUN}) order by score desc, siren limit 50 offset 100")
def list_leads_page(spark, d):
    return rel.page(run(spark, d, "raison_sociale", "score").select("siren", "raison_sociale", "score"), [F.col("score").desc(), F.col("siren")], 50, 100)


@query(f"select count(*) as n from ({RUN}) where segment in ('avocat_notaire', 'cgp') and score >= 40 and contains(lower(raison_sociale), 'conseil')")
def map_filter_count(spark, d):
    f = rel.LeadFilter(segments=["avocat_notaire", "cgp"], score_min=40, text="Conseil")
    return run(spark, d, "segment", "score", "raison_sociale").where(f.column()).agg(F.count(F.lit(1)).alias("n"))


@query(f"select siren, array_to_string(flags, ',') as flags from ({RUN}) where list_has_any(flags, ['CA en hausse'])")
def flag_filter(spark, d):
    return run(spark, d, "flags").where(rel.LeadFilter(flags=["CA en hausse"]).column()).select("siren", F.array_join("flags", ",").alias("flags"))


@query(f"select axe, valeur, n from (select 'bande' as axe, bande_score as valeur, count(*) as n from ({RUN}) group by all union all select 'segment', segment, count(*) from ({RUN}) group by all union all select * from (select 'departement', departement, count(*) as n from ({RUN}) group by all order by n desc, departement limit 12))")
def map_breakdown(spark, d):
    g = run(spark, d, "bande_score", "segment", "departement").groupingSets([["bande_score"], ["segment"], ["departement"]], "bande_score", "segment", "departement").agg(F.count(F.lit(1)).alias("n"), F.grouping("bande_score").alias("gb"), F.grouping("segment").alias("gs"))
    g = g.select(F.when(F.col("gb") == 0, "bande").when(F.col("gs") == 0, "segment").otherwise("departement").alias("axe"), F.when(F.col("gb") == 0, F.col("bande_score")).when(F.col("gs") == 0, F.col("segment")).otherwise(F.col("departement")).alias("valeur"), "n")
    top = F.row_number().over(Window.partitionBy("axe").orderBy(F.col("n").desc(), F.col("valeur").asc_nulls_last()))
    return g.withColumn("r", top).where((F.col("axe") != "departement") | (F.col("r") <= 12)).drop("r")


@query(f"select cast(floor(longitude / {360 / 2**11}::double) as int) as cx, cast(floor(latitude / {360 / 2**11}::double) as int) as cy, count(*) as n, round(avg(latitude), 6) as lat, round(avg(longitude), 6) as lon, min(siren) as siren from ({LATEST}) where latitude is not null and longitude is not null group by 1, 2")
def map_clusters(spark, d):
    return rel.clusters(register(spark, d, "siren", "latitude", "longitude"), 8)


@query(f"select siren, siret, est_siege, commune from ({LATEST}) where siren = (select min(siren) from cabinet)")
def firm_network(spark, d):
    c = register(spark, d, "siren", "est_siege", "commune")
    return c.join(F.broadcast(table(spark, d, "cabinet").agg(F.min("siren").alias("siren"))), "siren").select("siren", "siret", "est_siege", "commune")


@query(f"select tx, ty, count(*) as n from (select cast(floor((longitude + 180) / 360 * 1024) as int) as tx, cast(floor((1 - asinh(tan(radians(latitude))) / pi()) / 2 * 1024) as int) as ty from ({LATEST}) where latitude is not null and longitude is not null) group by tx, ty")
def tile_keys(spark, d):
    tx, ty = numeric.tile(F.col("latitude"), F.col("longitude"), 10)
    return register(spark, d, "latitude", "longitude").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy(tx.alias("tx"), ty.alias("ty")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select segment, departement, count(distinct siren) as firmes, count(distinct siren) filter (where siren in (select siren from enrichissement)) as enrichies from ({LATEST}) group by all")
def kpi_coverage(spark, d):
    e = table(spark, d, "enrichissement").select("siren").distinct().withColumn("e", F.lit(1))
    c = register(spark, d, "siren", "segment", "departement").select("siren", "segment", "departement").distinct().join(e, "siren", "left")
    return c.groupBy("segment", "departement").agg(F.count(F.lit(1)).alias("firmes"), F.count("e").alias("enrichies"))


# Scalar functions


_LADDER = "case " + " ".join(f"when regexp_matches(t, '{p}') then '{c}'" for c, p in text.TITLE_LADDER) + " else 'autre' end"


@query(f"select intitule, appellation, {_LADDER} as classe from (select distinct intitule, appellation, lower(concat_ws(' ', intitule, appellation)) as t from offre_emploi)")
def tag_metier(spark, d):
    return table(spark, d, "offre_emploi").select("intitule", "appellation").distinct().withColumn("classe", text.keyword_class(F.col("intitule"), F.col("appellation")))


@query("select kafka_partition, kafka_offset, ingest_date, case when json_valid(json) then json_extract_string(json, '$.intitule') end as intitule, case when json_valid(json) then json_extract_string(json, '$.typeContrat') end as type_contrat, case when json_valid(json) then cast(json_extract_string(json, '$.nombrePostes') as int) end as postes, case when json_valid(json) then cast(json_extract_string(json, '$.alternance') as boolean) end as alternance from offre_brute")
def json_parse(spark, d):
    o = table(spark, d, "offre_brute").select("kafka_partition", "kafka_offset", "ingest_date", F.explode(F.array(F.from_json("json", "map<string,string>"))).alias("m"))
    return o.select("kafka_partition", "kafka_offset", "ingest_date", F.col("m")["intitule"].alias("intitule"), F.col("m")["typeContrat"].alias("type_contrat"), F.col("m")["nombrePostes"].try_cast("int").alias("postes"), F.col("m")["alternance"].try_cast("boolean").alias("alternance"))


@query("select distinct code_commune, case when regexp_matches(code_commune, '^9[78]') then substr(code_commune, 1, 3) else substr(code_commune, 1, 2) end as dep from cabinet")
def commune_department(spark, d):
    return table(spark, d, "cabinet").select("code_commune").distinct().withColumn("dep", text.department(F.col("code_commune")))


@query(f"select siret, nullif(trim(concat_ws(' ', nullif(adresse, '[ND]'), code_postal, commune)), '') as ligne, year(date '{AS_OF}') - year(date_creation) as age, cast(cast(date_creation + interval 12 month as date) as varchar) as plus_un_an from ({LATEST})")
def address_and_age(spark, d):
    as_of = F.lit(AS_OF).cast("date")
    return register(spark, d, "adresse", "code_postal", "commune", "date_creation").select("siret", text.joined(F.nullif(F.col("adresse"), F.lit("[ND]")), F.col("code_postal"), F.col("commune")).alias("ligne"), (F.year(as_of) - F.year("date_creation")).cast("long").alias("age"), F.add_months("date_creation", 12).cast("string").alias("plus_un_an"))


@query(f"select siret, round(3 + degrees(atan2(x_lambert93 - 700000, {numeric.LAMBERT_YS!r}::double - y_lambert93) / {numeric.LAMBERT_N!r}::double), 7) as lon, round(degrees(chi + {' + '.join(f'{c!r}::double * sin({2 * (k + 1)} * chi)' for k, c in enumerate(numeric.CONFORMAL))}), 7) as lat from (select siret, x_lambert93, y_lambert93, 2 * atan(exp(-ln(sqrt(pow(x_lambert93 - 700000, 2) + pow({numeric.LAMBERT_YS!r}::double - y_lambert93, 2)) / {numeric.LAMBERT_C!r}::double) / {numeric.LAMBERT_N!r}::double)) - pi() / 2 as chi from ({LATEST}) where x_lambert93 <> 0 and y_lambert93 <> 0)")
def lambert_inverse(spark, d):
    x, y = F.col("x_lambert93"), F.col("y_lambert93")
    return register(spark, d, "x_lambert93", "y_lambert93").where((x != 0) & (y != 0)).select("siret", F.round(numeric.lambert93_longitude(x, y), 7).alias("lon"), F.round(numeric.lambert93_latitude(x, y), 7).alias("lat"))


@query()
def utm_inverse(spark, d):
    """Overseas projections: the establishments' own plane offsets taken as coordinates of the zone of La Réunion."""
    x, y = 500000 + F.pmod(F.col("x_lambert93"), F.lit(60000.0)) - 30000, 7640000 + F.pmod(F.col("y_lambert93"), F.lit(50000.0))
    return register(spark, d, "x_lambert93", "y_lambert93").where(F.col("x_lambert93").isNotNull()).select("siret", F.round(numeric.utm_latitude(x, y, 2975), 7).alias("lat"), F.round(numeric.utm_longitude(x, y, 2975), 7).alias("lon"))


@query("select distinct url_origine, regexp_replace(lower(regexp_extract(url_origine, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/:?#]+)', 1)), '^www\\.', '') as hote, array_to_string(string_split(regexp_replace(lower(regexp_extract(url_origine, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/:?#]+)', 1)), '^www\\.', ''), '.')[-2:], '.') as domaine from offre_emploi where url_origine is not null")
def host_registrable(spark, d):
    h = text.host(F.col("url_origine"))
    return table(spark, d, "offre_emploi").where(F.col("url_origine").isNotNull()).select("url_origine").distinct().select("url_origine", h.alias("hote"), text.registrable(h).alias("domaine"))


@query(f"select siren, case when ca >= 1000000 then regexp_replace(printf('%.1f', round(ca / 1e6, 1)), '\\.0$', '') || 'M' when ca >= 1000 then regexp_replace(printf('%.1f', round(ca / 1e3, 1)), '\\.0$', '') || 'k' else cast(ca as varchar) end as libelle from ({RUN})")
def count_labels(spark, d):
    return run(spark, d, "ca").select("siren", text.count_label(F.col("ca")).alias("libelle"))


# Streaming


@query("select offre_id, count(*) as n, max(kafka_offset) as dernier from offre_brute where offre_id is not null group by offre_id")
def stream_append(spark, d):
    """The message log through a file stream into a table by day, taken to its end, then summed up by identifier."""
    source = f"{d}/offre_brute.parquet"
    sink, state = new_path(spark, "stream"), new_path(spark, "stream-state")
    stream = streaming.file_source(spark, source if os.path.isdir(source) or "://" in source else f"{d}/offre_brut[e].parquet")
    done = streaming.DaySink(sink, state, day=F.date_format("kafka_ts", "yyyy-MM-dd")).start(stream.drop("ingest_date"))
    done.awaitTermination()
    return spark.read.parquet(sink).where(F.col("offre_id").isNotNull()).groupBy("offre_id").agg(F.count(F.lit(1)).alias("n"), F.max("kafka_offset").alias("dernier"))
