"""Queries of the serving surface and of the chains that build the tables, each with the SQL it must equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galena.functions import numeric, text
from galena.operators import relational as rel
from galena.operators import serving
from galena.operators.nearby import near_pairs
from galena.plans.catalogue import _EVENTS, _KM, AS_OF, LATEST, OFFERS, RUN, _key_sql, offers, register, run
from galena.session import bounded
from galena.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FREE = "not coalesce(flag_ca_hausse, false)"


@query(f"select siren, score, segment, (select count(*) from ({RUN}) where {_FREE} and segment = 'avocat_notaire' and nb_offres_90j > 0) as total from ({RUN}) where {_FREE} and segment = 'avocat_notaire' and nb_offres_90j > 0 order by score desc, siren limit 50 offset 0")
def leads_list(spark, d):
    """One page of the ranked list: flagged firms left out, unknown flags kept, a segment, a recent offer, the total."""
    f = serving.not_excluded(F.col("flag_ca_hausse")) & rel.LeadFilter(segments=["avocat_notaire"]).column() & (F.col("nb_offres_90j") > 0)
    return serving.listed(run(spark, d, "score", "segment", "flag_ca_hausse", "nb_offres_90j").select("siren", "score", "segment", "flag_ca_hausse", "nb_offres_90j"), f, [F.col("score").desc(), F.col("siren")], 50).select("siren", "score", "segment", "total")


_REGION = ", ".join(f"'{x}'" for r in ("84", "75", "11") for x in serving.departments(r))


@query(f"select siren, departement, segment, bande_score from ({RUN}) where departement in ({_REGION}) and segment in ('expert_comptable', 'cgp') and code_ape in ('69.20Z', '66.22Z', '66.19B') and bande_score in ('chaud', 'tiede') and nb_etablissements >= 2 and score >= 20 and (contains(lower(raison_sociale), 'a'))")
def map_filter_chain(spark, d):
    """Every filter of the map at once: regions, segments, activity codes, bands, network, least score, part of the name."""
    f = rel.LeadFilter(segments=["expert_comptable", "cgp"], departments=[x for r in ("84", "75", "11") for x in serving.departments(r)], bands=["chaud", "tiede"], score_min=20, text="A")
    more = F.col("code_ape").isin("69.20Z", "66.22Z", "66.19B") & (F.col("nb_etablissements") >= 2)
    return run(spark, d, "departement", "segment", "bande_score", "raison_sociale", "code_ape", "nb_etablissements", "score").where(f.column() & more).select("siren", "departement", "segment", "bande_score")


@query(f"select siren, found, score from (select a.siren, l.siren is not null as found, l.score from (select min(siren) as siren from ({RUN}) union all select '000000000') a left join (select siren, min(score) as score from ({RUN}) group by siren) l using (siren))")
def lead_lookup(spark, d):
    t = run(spark, d, "score").select("siren", "score")
    return serving.lookup(t, "siren", [t.agg(F.min("siren")).first()[0] or "", "000000000"], ["score"])


@query(f"select siret, round(longitude * 1e5) / 1e5 as lon, round(latitude * 1e5) / 1e5 as lat from ({LATEST}) where longitude is not null and latitude is not null order by siret, 2, 3 limit 400000")
def map_bulk(spark, d):
    return serving.bulk_points(register(spark, d, "longitude", "latitude"), "siret")


_CELL = f"{360 / 2**12}::double"


@query(f"select cx, cy, n, lat, lon, case when n = 1 then siren end as siren, case when n >= 1000 then regexp_replace(printf('%.1f', round(n / 1e3, 1)), '\\.0$', '') || 'k' when n > 1 then cast(n as varchar) end as libelle from (select cast(floor(longitude / {_CELL}) as int) as cx, cast(floor(latitude / {_CELL}) as int) as cy, count(*) as n, round(avg(latitude), 6) as lat, round(avg(longitude), 6) as lon, min(siren) as siren from ({LATEST}) where latitude is not null and longitude is not null group by 1, 2)")
def map_labelled_clusters(spark, d):
    return serving.labelled_clusters(register(spark, d, "siren", "latitude", "longitude"), 9)


@query(f"select departement, segment, count(*) as n from ({LATEST}) where segment = 'avocat_notaire' and latitude between 43 and 49 and longitude between -1 and 6 group by all")
def zones_in_box(spark, d):
    c = register(spark, d, "departement", "segment", "latitude", "longitude")
    return c.where((F.col("segment") == "avocat_notaire") & serving.in_box(F.col("longitude"), F.col("latitude"), (-1, 43, 6, 49))).groupBy("departement", "segment").agg(F.count(F.lit(1)).alias("n"))


@query(f"select siren, siret, est_siege, row_number() over (order by est_siege desc nulls last, siret) as rang from ({LATEST}) where siren = (select siren from ({LATEST}) group by siren order by count(*) desc, siren limit 1)")
def network_head_first(spark, d):
    """The sites of the firm with the most, its head office first."""
    c = register(spark, d, "siren", "est_siege")
    top = c.groupBy("siren").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "siren").limit(1).select("siren")
    order = [F.col("est_siege").desc_nulls_last(), F.col("siret")]
    return c.join(F.broadcast(top), "siren").select("siren", "siret", "est_siege", F.row_number().over(Window.partitionBy("siren").orderBy(*order)).alias("rang"))


@query(f"select segment, departement, count(distinct siren) as nb_cabinets from ({LATEST}) where segment is not null group by all")
def kpi_market(spark, d):
    t = register(spark, d, "siren", "segment", "departement").where(F.col("segment").isNotNull()).groupBy("segment", "departement").agg(F.count_distinct("siren").alias("nb_cabinets"))
    return serving.kpi({"kpi_marche": t}, "kpi_marche")


@query("select unnest(['cabinet', 'leads_scored', 'absente']) as nom, unnest([true, true, false]) as lisible")
def lake_health(spark, d):
    """Which tables of the lake can be read."""
    from pyspark.errors import AnalysisException

    def readable(name: str) -> bool:
        try:
            return bool(table(spark, d, name).schema)
        except AnalysisException:
            return False

    return spark.createDataFrame([(n, readable(n)) for n in ("cabinet", "leads_scored", "absente")], "nom string, lisible boolean")


@query(f"""select siret, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || round(longitude * 1e5) / 1e5 || ',' || round(latitude * 1e5) / 1e5 || ']}},"properties":{{"siren":' || to_json(siren) || coalesce(',"raison_sociale":' || to_json(raison_sociale), '') || coalesce(',"segment":' || to_json(segment), '') || case when est_ess then ',"ess":true' else '' end || '}}}}' as feature from ({LATEST}) where latitude is not null and longitude is not null and siren is not null""")
def geojson_features(spark, d):
    """One GeoJSON feature per placed establishment; null and false properties are left out."""
    c = register(spark, d, "siren", "raison_sociale", "segment", "est_ess", "latitude", "longitude").where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("siren").isNotNull())
    p = [F.col("siren"), F.col("raison_sociale"), F.col("segment"), F.when(F.col("est_ess"), True).alias("ess")]
    return c.select("siret", serving.feature((serving.five_digits(F.col("longitude")), serving.five_digits(F.col("latitude"))), p).alias("feature"))


@query(f"""with f as (select siren, max(latitude) as latitude, max(longitude) as longitude from ({LATEST}) where est_siege and latitude is not null and longitude is not null group by siren)
select siren, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || round(longitude * 1e5) / 1e5 || ',' || round(latitude * 1e5) / 1e5 || ']}},"properties":{{"siren":' || to_json(siren) || ',"offres":' || nb_offres_30j || '}}}}' as feature from (select siren, max(nb_offres_30j) as nb_offres_30j from ({RUN}) where nb_offres_30j > 0 group by siren) join f using (siren)""")
def geojson_signals(spark, d):
    """The second layer: firms with recent offers, at their head office."""
    at = register(spark, d, "siren", "est_siege", "latitude", "longitude").where(F.col("est_siege") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy("siren").agg(F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))
    s = run(spark, d, "nb_offres_30j").where(F.col("nb_offres_30j") > 0).groupBy("siren").agg(F.max("nb_offres_30j").alias("offres")).join(at, "siren")
    return s.select("siren", serving.feature((serving.five_digits(F.col("longitude")), serving.five_digits(F.col("latitude"))), [F.col("siren"), F.col("offres")]).alias("feature"))


# Chains


_LAT = f"degrees(chi + {' + '.join(f'{c!r}::double * sin({2 * (k + 1)} * chi)' for k, c in enumerate(numeric.CONFORMAL))})"
_LON = f"3 + degrees(atan2(x - 700000, {numeric.LAMBERT_YS!r}::double - y) / {numeric.LAMBERT_N!r}::double)"


@query(f"""with c as (select distinct siren, siret, segment, code_ape, categorie_juridique, adresse, code_postal, commune, date_creation, code_commune, x_lambert93 as x, y_lambert93 as y from ({LATEST}) where code_ape in ('69.20Z', '69.10Z', '66.22Z') and not regexp_matches(coalesce(code_commune, ''), '^97')),
dim as (select categorie_juridique as code, min(forme_juridique) as libelle from cabinet where regexp_matches(categorie_juridique, '^[0-9]{{4}}$') group by 1),
g as (select *, case when x <> 0 and y <> 0 then 2 * atan(exp(-ln(sqrt(pow(x - 700000, 2) + pow({numeric.LAMBERT_YS!r}::double - y, 2)) / {numeric.LAMBERT_C!r}::double) / {numeric.LAMBERT_N!r}::double)) - pi() / 2 end as chi from c),
p as (select *, {_LAT} as la, {_LON} as lo from g),
b as (select *, lo between -6 and 11 and la between 41 and 52 as ok from p)
select siret, siren, coalesce(libelle, 'Cat. ' || categorie_juridique) as forme, nullif(trim(concat_ws(' ', nullif(adresse, '[ND]'), code_postal, commune)), '') as ligne, case when ok and chi is not null then round(la, 6) end as lat, case when ok and chi is not null then round(lo, 6) end as lon
from b left join dim on categorie_juridique = code qualify row_number() over (partition by siret order by date_creation desc nulls last, segment nulls last, adresse nulls last, commune nulls last, x nulls last, y nulls last) = 1""")
def establishment_chain(spark, d):
    """Establishments shaped: activity codes, a dimension joined by another key's name with a fallback label, the
    address, plane coordinates to degrees by territory with a box test, the best row of each."""
    c = register(spark, d, "siren", "segment", "code_ape", "categorie_juridique", "adresse", "code_postal", "commune", "date_creation", "code_commune", "x_lambert93", "y_lambert93")
    c = c.where(F.col("code_ape").isin("69.20Z", "69.10Z", "66.22Z") & ~F.coalesce(F.col("code_commune"), F.lit("")).rlike("^97"))
    dim = table(spark, d, "cabinet").where(F.col("categorie_juridique").rlike("^[0-9]{4}$")).groupBy(F.col("categorie_juridique").alias("code")).agg(F.min("forme_juridique").alias("libelle"))
    x, y = F.col("x_lambert93"), F.col("y_lambert93")
    lat, lon = serving.placed_from_plane(x, y, F.col("code_commune"), {"971": 5490, "972": 5490, "973": 2972, "974": 2975, "976": 4471}, {"971": (-62, 15, -60, 17), "972": (-62, 14, -60, 15), "973": (-55, 2, -51, 6), "974": (55, -22, 56, -20), "976": (44, -14, 46, -12)}, (-6, 41, 11, 52))
    j = c.join(bounded(dim), F.col("categorie_juridique") == F.col("code"), "left")
    best = rel.best_per_key(j, ["siret"], [F.col("date_creation").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in ("segment", "adresse", "commune", "x_lambert93", "y_lambert93")]])
    return best.select("siret", "siren", F.coalesce("libelle", F.concat(F.lit("Cat. "), F.col("categorie_juridique"))).alias("forme"), text.joined(F.nullif(F.col("adresse"), F.lit("[ND]")), F.col("code_postal"), F.col("commune")).alias("ligne"), F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


def _tiers(spark: SparkSession, d: str) -> DataFrame:
    """(offre_id, siret, siren, palier, metres): the best establishment of each offer by name and place.

    Candidates are the establishments within 250 m and, by name, the best of each (name, commune), (name, department)
    and name: these are chosen before the join, so that a name with very many sites or offers costs a lookup each."""
    o = offers(spark, d).select("offre_id", "code_commune", "departement", "latitude", "longitude", text.company_key(F.col("entreprise_nom")).alias("k"))
    c = register(spark, d, "siren", "code_commune", "departement", "latitude", "longitude", "raison_sociale", "enseigne")
    c = c.select("siren", "siret", F.col("code_commune").alias("fc"), F.col("departement").alias("fd"), "latitude", "longitude", text.company_key(F.col("raison_sociale")).alias("a"), text.company_key(F.col("enseigne")).alias("b"))
    exact = (F.col("k") != "") & ((F.col("k") == F.col("a")) | (F.col("k") == F.col("b")))
    jac = text.jaccard(F.col("k"), F.col("a"))
    near = near_pairs(o, c, 250.0, "offre_id", "siret", distance="m")
    site = rel.best_per_key(c, ["siret"], [F.col(x).asc_nulls_last() for x in ("a", "b", "fc", "fd", "siren")]).drop("latitude", "longitude")
    g = near.join(o.select("offre_id", "k", "code_commune", "departement"), "offre_id").join(site, "siret")
    same_c, same_d = F.coalesce(F.col("code_commune") == F.col("fc"), F.lit(False)), F.coalesce(F.col("departement") == F.col("fd"), F.lit(False))
    geo_name = (F.col("m") <= 200) & (exact | (jac >= 0.4))
    tier = F.when(geo_name, 5).when(exact & same_c, 4).when(F.col("m") <= 120, 3).when(exact & same_d, 2).when(exact, 1).otherwise(0)
    by_place = g.select("offre_id", "siret", "siren", tier.alias("palier"), F.round("m", 3).alias("metres"), F.round(jac, 6).alias("j"))
    names = site.select("siret", "siren", "fc", "fd", F.explode(F.array_distinct(F.array("a", "b"))).alias("n"), "a").where(F.col("n") != "").withColumn("j", F.round(text.jaccard(F.col("n"), F.col("a")), 6))
    parts = [by_place]
    for palier, place, other in ((4, "code_commune", "fc"), (2, "departement", "fd"), (1, None, None)):
        keys = ["n", other] if other else ["n"]
        top = names.groupBy(*keys).agg(F.min(F.struct((-F.col("j")).alias("nj"), "siret", "siren")).alias("s")).select(*keys, "s.*")
        on = [F.col("k") == F.col("n")] + ([F.col(place) == F.col(other)] if other else [])
        parts.append(o.join(top, reduce(lambda x, y: x & y, on)).select("offre_id", "siret", "siren", F.lit(palier).alias("palier"), F.lit(None).cast("double").alias("metres"), (-F.col("nj")).alias("j")))
    u = reduce(DataFrame.unionByName, parts).where(F.col("palier") > 0)
    return rel.best_per_key(u, ["offre_id"], [F.col("palier").desc(), F.col("metres").asc_nulls_last(), F.col("j").desc(), F.col("siret")]).drop("j")


_JAC = "case when len(x) + len(y) - len(list_intersect(x, y)) > 0 then round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y)))::double, 6) else 0 end"
_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda w: w <> ''))"
_TIERS = f"""o as (select offre_id, code_commune, departement, latitude, longitude, {_key_sql('entreprise_nom')} as k from ({OFFERS})),
r as (select *, {_key_sql('raison_sociale')} as a, {_key_sql('enseigne')} as b, code_commune as fc, departement as fd from ({LATEST})),
site as (select siret, siren, a, b, fc, fd, latitude, longitude, {_WORDS.format('a')} as y from r qualify row_number() over (partition by siret order by a nulls last, b nulls last, fc nulls last, fd nulls last, siren nulls last) = 1),
place as (select distinct siret, latitude, longitude from r where latitude is not null and longitude is not null and not (latitude = 0 and longitude = 0)),
near as (select offre_id, c.siret, min({_KM}) as m from o join place c on abs(c.latitude - o.latitude) < 3e-3 and abs(c.longitude - o.longitude) < 5e-3 where not (o.latitude = 0 and o.longitude = 0) and {_KM} <= 250 group by 1, 2),
g as (select offre_id, s.siret, s.siren, m, k <> '' and (k = a or coalesce(k = b, false)) as e, coalesce(o.code_commune = fc, false) as ec, coalesce(o.departement = fd, false) as ed, {_WORDS.format('k')} as x, y from near join o using (offre_id) join site s on near.siret = s.siret),
gt as (select offre_id, siret, siren, m, {_JAC} as j, e, ec, ed from g),
n as (select offre_id, s.siret, s.siren, o.code_commune = fc as ec, o.departement = fd as ed, {_WORDS.format('k')} as x, y from o join site s on k <> '' and (k = a or k = b)),
u as (select offre_id, siret, siren, case when m <= 200 and (e or j >= 0.4) then 5 when e and ec then 4 when m <= 120 then 3 when e and ed then 2 when e then 1 else 0 end as palier, round(m, 3) as metres, j from gt
union all select offre_id, siret, siren, case when ec then 4 when ed then 2 else 1 end, null, {_JAC} from n),
best as (select offre_id, siret, siren, palier, metres from u where palier > 0 qualify row_number() over (partition by offre_id order by palier desc, metres nulls last, j desc, siret) = 1)"""


@query(f"with {_TIERS} select offre_id, siret, siren, palier, metres from best")
def offer_tiers(spark, d):
    """Offers attached to establishments: candidates by place and name, tiers with distance and likeness, the best one."""
    return _tiers(spark, d)


@query(f"""with {_TIERS}, s as (select b.siren, f.* exclude (siren_) from best b join (select *, null as siren_ from ({OFFERS})) f using (offre_id) where palier in (5, 4, 3, 2)),
w as (select * from s where date_creation::date between (select max(date_creation::date) from s) - 90 and (select max(date_creation::date) from s))
select siren, count(*) as n90, count(*) filter (where date_creation::date > (select max(date_creation::date) from s) - 30) as n30, cast(sum(coalesce(nombre_postes, 1)) as bigint) as postes, count(*) filter (where metier = 'paie') as paie, count(*) filter (where metier = 'comptabilite') as comptabilite, array_to_string(list_sort(list(distinct type_contrat) filter (where type_contrat is not null)), ',') as types from w group by siren""")
def firm_offer_signal(spark, d):
    """Recent offers by firm, up to the latest day in the data: counts, posts, kinds of contract, and a pivot by trade."""
    t = _tiers(spark, d).where(F.col("palier").isin(5, 4, 3, 2)).select("offre_id", "siren")
    o = offers(spark, d).select("offre_id", F.to_date("date_creation").alias("day"), "nombre_postes", "metier", "type_contrat").join(t, "offre_id")
    last = F.lit(o.agg(F.max("day")).first()[0])
    w = o.where(F.col("day").between(F.date_sub(last, 90), last))
    a = w.groupBy("siren").agg(F.count(F.lit(1)).alias("n90"), F.count_if(F.col("day") > F.date_sub(last, 30)).alias("n30"), F.sum(F.coalesce("nombre_postes", F.lit(1))).alias("postes"), F.array_join(F.sort_array(F.collect_set("type_contrat")), ",").alias("types"))
    p = w.groupBy("siren").pivot("metier", ["paie", "comptabilite"]).agg(F.count(F.lit(1)))
    return a.join(p, "siren", "left").select("siren", "n90", "n30", "postes", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("paie", "comptabilite")], "types")


_HEAD = "g.rant|pr.sident|dirigeant|nomination"
_DETAILED = _EVENTS.replace("json_extract_string(e, '$.type') as type", "json_extract_string(e, '$.type') as type, json_extract_string(e, '$.detail') as detail")


@query(f"""with e as (select siren, max(ca) as ca, max(nullif(ca_n1, 0)) as ca_n1 from enrichissement group by siren), r as (select siren, max(nb_etablissements_ouverts) as ouverts from recherche_entreprises group by siren),
v as (select siren, bool_or(coalesce(jour >= cast(date '{AS_OF}' - interval 12 month as date)::varchar and regexp_matches(lower(coalesce(detail, '')), '{_HEAD}'), false)) as nouveau_dirigeant, bool_or(coalesce(jour >= cast(date '{AS_OF}' - interval 9 month as date)::varchar and type like 'vente%', false)) as acquisition, bool_or(coalesce(contains(lower(detail), 'redressement'), false)) as redressement, bool_or(coalesce(type like 'radiation%', false)) as radiee, min(jour) filter (where type = 'procédure collective') as procedure, max(jour) filter (where type = 'dépôt des comptes') as depot from ({_DETAILED}) group by siren)
select siren, ouverts, coalesce(round((ca - ca_n1) / abs(ca_n1)::double, 4) > 0.10, false) as hausse, coalesce(round((ca - ca_n1) / abs(ca_n1)::double, 4) < -0.10, false) as baisse, coalesce(nouveau_dirigeant, false) as nouveau_dirigeant, coalesce(acquisition, false) as acquisition, coalesce(redressement, false) as redressement, coalesce(radiee, false) as radiee, procedure, depot from e full join r using (siren) left join v using (siren)""")
def enrichment_flags(spark, d):
    """Sources merged by firm with growth flags and what the legal events of the last months tell, first and last by kind."""
    e = table(spark, d, "enrichissement")
    a = e.groupBy("siren").agg(F.max("ca").alias("ca"), F.max(F.nullif(F.col("ca_n1"), F.lit(0))).alias("ca_n1"))
    r = table(spark, d, "recherche_entreprises").groupBy("siren").agg(F.max("nb_etablissements_ouverts").alias("ouverts"))
    v = e.select("siren", "bodacc_evenements").distinct().where(F.col("bodacc_evenements").rlike(r"^\s*\["))
    v = v.select("siren", F.explode(F.from_json("bodacc_evenements", "array<string>")).alias("x")).where(F.col("x").startswith("{")).select("siren", F.from_json("x", "date string, type string, detail string").alias("e")).select("siren", F.col("e.date").alias("jour"), F.col("e.type").alias("type"), F.col("e.detail").alias("detail"))
    since = lambda months: F.add_months(F.lit(AS_OF).cast("date"), -months).cast("string")
    yes = lambda c: F.bool_or(F.coalesce(c, F.lit(False)))
    v = v.groupBy("siren").agg(
        yes((F.col("jour") >= since(12)) & F.lower(F.coalesce("detail", F.lit(""))).rlike(_HEAD)).alias("nouveau_dirigeant"),
        yes((F.col("jour") >= since(9)) & F.col("type").startswith("vente")).alias("acquisition"),
        yes(F.lower("detail").contains("redressement")).alias("redressement"),
        yes(F.col("type").startswith("radiation")).alias("radiee"),
        F.min(F.when(F.col("type") == "procédure collective", F.col("jour"))).alias("procedure"),
        F.max(F.when(F.col("type") == "dépôt des comptes", F.col("jour"))).alias("depot"),
    )
    g = numeric.growth(F.col("ca"), F.col("ca_n1"))
    no = lambda c: F.coalesce(c, F.lit(False))
    m = rel.merge_by_key([a, r], "siren").join(v, "siren", "left")
    return m.select("siren", "ouverts", no(g > 0.10).alias("hausse"), no(g < -0.10).alias("baisse"), *[no(F.col(c)).alias(c) for c in ("nouveau_dirigeant", "acquisition", "redressement", "radiee")], "procedure", "depot")


@query("""select distinct siren, case when json_extract_string(p, '$.type') = 'personne morale' then json_extract_string(p, '$.nom') else list_reduce(list_transform(string_split(lower(json_extract_string(p, '$.nom')), ' '), lambda w: upper(w[1]) || w[2:]), lambda x, y: x || ' ' || y) end || coalesce(', ' || json_extract_string(p, '$.qualite'), '') as libelle
from (select siren, json_extract(dirigeants, '$[0]') as p from recherche_entreprises where case when json_valid(dirigeants) then json_type(dirigeants) = 'ARRAY' else false end) where json_type(p) = 'OBJECT' and json_extract_string(p, '$.nom') is not null""")
def first_officer_label(spark, d):
    """The first officer of each firm as a label: a company by its name, a person in title case, with the quality."""
    t = table(spark, d, "recherche_entreprises").where(F.col("dirigeants").rlike(r"^\s*\["))
    p = t.select("siren", F.from_json("dirigeants", "array<string>").alias("a")).select("siren", F.from_json(F.try_element_at("a", F.lit(1)), "nom string, qualite string, type string").alias("p")).where(F.try_element_at("a", F.lit(1)).startswith("{"))
    return p.select("siren", text.person_label(F.col("p.nom"), F.col("p.qualite"), F.col("p.type") == "personne morale").alias("libelle")).where(F.col("libelle").isNotNull()).distinct()


@query("""select siren, annee, ca, annee_n1, ca_n1 from (select distinct siren, greatest(annee_comptes, annee_comptes_n1) as annee, case when annee_comptes > annee_comptes_n1 then ca else ca_n1 end as ca, least(annee_comptes, annee_comptes_n1) as annee_n1, case when annee_comptes > annee_comptes_n1 then ca_n1 else ca end as ca_n1 from recherche_entreprises where annee_comptes is not null and annee_comptes_n1 is not null and annee_comptes <> annee_comptes_n1)""")
def latest_two_years(spark, d):
    """An object keyed by year, as a service delivers it, taken apart: the latest two years with their figures."""
    t = table(spark, d, "recherche_entreprises").where(F.col("annee_comptes").isNotNull() & F.col("annee_comptes_n1").isNotNull() & (F.col("annee_comptes") != F.col("annee_comptes_n1")))
    year = lambda a, c: F.struct(F.col(a).cast("string"), F.struct(F.col(c).alias("ca")))
    t = t.select("siren", F.to_json(F.map_from_entries(F.array(year("annee_comptes", "ca"), year("annee_comptes_n1", "ca_n1")))).alias("finances"))
    two = text.latest_keys(F.from_json("finances", "map<string,struct<ca:bigint>>"), 2)
    return t.select("siren", two.alias("y")).select("siren", F.col("y")[0]["key"].cast("int").alias("annee"), F.col("y")[0]["value"]["ca"].alias("ca"), F.col("y")[1]["key"].cast("int").alias("annee_n1"), F.col("y")[1]["value"]["ca"].alias("ca_n1")).distinct()


@query("""with u as (select lpad(siren, 9, '0') as siren, year(try_cast(run_date as date)) as annee, run_date, bande_score, ca, resultat_net from leads_scored where ca > 0),
b as (select * from u qualify row_number() over (partition by siren, annee order by case bande_score when 'chaud' then 0 when 'tiede' then 1 else 2 end, run_date desc, ca desc, resultat_net desc nulls last) = 1)
select siren, annee, cast(round_even(ca / 1000e0, 0) as bigint) as ca_k, cast(round_even(resultat_net / 1000e0, 0) as bigint) as resultat_k from b qualify row_number() over (partition by siren order by annee desc) <= 2""")
def exercise_selection(spark, d):
    """Of each firm and year the row of the best kind, then its two latest years; amounts in thousands, halves to even."""
    t = table(spark, d, "leads_scored").where(F.col("ca") > 0).select(F.when(F.length("siren") < 9, F.lpad("siren", 9, "0")).otherwise(F.col("siren")).alias("siren"), F.year(F.try_to_timestamp("run_date")).alias("annee"), "run_date", "bande_score", "ca", "resultat_net")
    rank = F.when(F.col("bande_score") == "chaud", 0).when(F.col("bande_score") == "tiede", 1).otherwise(2)
    b = rel.best_per_key(t, ["siren", "annee"], [rank, F.col("run_date").desc(), F.col("ca").desc(), F.col("resultat_net").desc_nulls_last()])
    return rel.best_per_key(b, ["siren"], [F.col("annee").desc()], 2).select("siren", "annee", F.bround(F.col("ca") / 1000.0, 0).cast("long").alias("ca_k"), F.bround(F.col("resultat_net") / 1000.0, 0).cast("long").alias("resultat_k"))


@query("with h as (select regexp_replace(lower(regexp_extract(url_origine, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/:?#]+)', 1)), '^www\\.', '') as hote, count(*) as n from offre_emploi group by 1) select hote, n from h where hote <> '' and hote not in ('emplois.bloque.example') and array_to_string(string_split(hote, '.')[-2:], '.') <> 'bloque.example'")
def hosts_not_blocked(spark, d):
    """Hosts on no blocklist, be it the host itself or its registrable domain."""
    h = table(spark, d, "offre_emploi").select(text.host(F.col("url_origine")).alias("hote")).where(F.col("hote").isNotNull()).groupBy("hote").agg(F.count(F.lit(1)).alias("n"))
    hosts = spark.createDataFrame([("emplois.bloque.example",)], "hote string")
    domains = spark.createDataFrame([("bloque.example",)], "domaine string")
    return h.join(bounded(hosts), "hote", "left_anti").withColumn("domaine", text.registrable(F.col("hote"))).join(bounded(domains), "domaine", "left_anti").select("hote", "n")


# Queues, shapes


@query(f"""with q as (select siren, min(bande_score) as etat, max(score) as score, cast(0 as int) as essais from ({RUN}) group by siren), r as (select distinct siren from enrichissement where ca > 0)
select etat, count(*) as n, cast(sum(essais) as bigint) as essais, min(du) as du from (select case when r.siren is not null then 'fait' else etat end as etat, essais + case when r.siren is not null then 1 else 0 end as essais, case when r.siren is null then null when score >= 70 then '2025-07-03' when score >= 45 then '2025-09-01' else '2025-11-30' end as du from q left join r using (siren)) group by etat""")
def queue_transition(spark, d):
    """Results applied to a queue (state, attempts, next day by bands of a number), then counted by state."""
    q = run(spark, d, "bande_score", "score").groupBy("siren").agg(F.min("bande_score").alias("etat"), F.max("score").alias("score")).withColumn("essais", F.lit(0))
    r = table(spark, d, "enrichissement").where(F.col("ca") > 0).select("siren").distinct().withColumn("nouveau", F.lit("fait"))
    t = rel.transition(q, r, "siren", "etat", "nouveau", "essais").withColumn("du", F.when(F.col("nouveau").isNotNull(), rel.due(F.lit(AS_OF).cast("date"), F.col("score"), ((70, 30), (45, 90)), 180).cast("string")))
    return t.groupBy("etat").agg(F.count(F.lit(1)).alias("n"), F.sum("essais").alias("essais"), F.min("du").alias("du"))


@query("select cle from (select distinct siren as cle from enrichissement where siren is not null union select distinct siren from recherche_entreprises where siren is not null)")
def processed_keys(spark, d):
    """The union of the keys that any run has handled."""
    return table(spark, d, "enrichissement").select(F.col("siren").alias("cle")).union(table(spark, d, "recherche_entreprises").select("siren")).where(F.col("cle").isNotNull()).distinct()


@query(f"select siret, coalesce(forme_juridique, 'Cat. ' || categorie_juridique) as forme, categorie_juridique not like '1%' as structuree, 'ville ' || commune as ville, regexp_extract(data_version, '([0-9]{{4}}-[0-9]{{2}})', 1) as mois from ({LATEST})")
def label_forms(spark, d):
    """Labels with a fallback, a prefix test, a label that is null with its part, the month of a version's name."""
    c = register(spark, d, "forme_juridique", "categorie_juridique", "commune", "data_version")
    return c.select("siret", F.coalesce("forme_juridique", F.concat(F.lit("Cat. "), F.col("categorie_juridique"))).alias("forme"), (~F.col("categorie_juridique").rlike("^1")).alias("structuree"), F.concat(F.lit("ville "), F.col("commune")).alias("ville"), F.regexp_extract("data_version", "([0-9]{4}-[0-9]{2})", 1).alias("mois"))


@query(f"select siren, round(least(1, ln(1 + greatest(coalesce(nb_etablissements, 1) - 1, 0)) / ln(10)), 6) as reseau, len(coalesce(flags, [])) as marques, coalesce(motifs_score[1], '-') as premier from ({RUN})")
def network_and_lists(spark, d):
    """Size of a network on a logarithmic scale, the length of a list that may be null, its first element."""
    return run(spark, d, "nb_etablissements", "flags", "motifs_score").select("siren", F.round(serving.network_size(F.col("nb_etablissements")), 6).alias("reseau"), F.size(F.coalesce("flags", F.array().cast("array<string>"))).cast("long").alias("marques"), F.coalesce(F.try_element_at("motifs_score", F.lit(1)), F.lit("-")).alias("premier"))


_DIGITS = "'1' || substr(siren, 1, 8)"


@query(f"select siren, '0' || d[1:1] || ' ' || d[2:3] || ' ' || d[4:5] || ' ' || d[6:7] || ' ' || d[8:9] as telephone, 'contact@s' || siren || '.example' as email, siren as numero, '/contact-' || siren as lien from (select distinct siren, {_DIGITS} as d from cabinet where length(siren) = 9)")
def contact_extract(spark, d):
    """Phone number, address, nine-digit number and contact link of the pages that firms might have, written in several ways."""
    t = table(spark, d, "cabinet").where(F.length("siren") == 9).select("siren").distinct().withColumn("d", F.concat(F.lit("1"), F.substring("siren", 1, 8)))
    pairs = lambda sep: F.regexp_replace(F.substring("d", 2, 8), "(..)(?=.)", f"$1{sep}")
    odd = F.substring("siren", 9, 1).isin("1", "3", "5", "7", "9")
    phone = F.when(odd, F.concat(F.lit("+33 1 "), pairs(" "))).otherwise(F.concat(F.lit("01."), pairs(".")))
    number = F.when(odd, F.regexp_replace("siren", "(...)(?=.)", "$1 ")).otherwise(F.col("siren"))
    page = F.concat(F.lit("<p>Appelez le "), phone, F.lit(", SIREN "), number, F.lit(" ou Contact@S"), "siren", F.lit(".example, logo@2x.png.</p><a href='/contact-"), "siren", F.lit("'>x</a><a href='mailto:noreply@b.example'>y</a>"))
    t = t.select("siren", page.alias("page"))
    return t.select("siren", *[F.array_join(f(F.col("page")), "|").alias(n) for n, f in (("telephone", text.phones), ("email", text.emails), ("numero", text.nine_digit_ids), ("lien", text.contact_links))])


@query("select offre_id, strftime(min(date_trunc('second', kafka_ts)), '%Y-%m-%dT%H:%M:%SZ') as premier from offre_brute where offre_id is not null group by offre_id")
def first_second(spark, d):
    """The first time of each message to the second, as ISO text."""
    return table(spark, d, "offre_brute").where(F.col("offre_id").isNotNull()).groupBy("offre_id").agg(F.date_format(F.min(F.date_trunc("second", F.col("kafka_ts").cast("timestamp"))), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("premier"))


@query("select nom, n from (select 'cabinet' as nom, count(*) as n from cabinet union all select 'nom_saisi', count(*) from nom_saisi union all select 'documents', count(*) from documents)")
def table_sizes(spark, d):
    """Row counts, which Parquet's footers hold."""
    return reduce(DataFrame.unionByName, [table(spark, d, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("nom"), "n") for n in ("cabinet", "nom_saisi", "documents")])
