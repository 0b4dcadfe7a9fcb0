"""Matching records of two sources that share no key: blocking by hashed elements, pairwise features, a calibrated classifier."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galena.llm.blocks import candidates, elements, rarity, shortened, spelled, word_rows
from galena.llm.names import activity_classes, align, is_core, normalized, word_index
from galena.session import materialize

#: At most so many labelled pairs, about, fit the classifier (half of them calibrate it).
SAMPLE = 20_000
#: Side of a cell for nearness, in degrees: what lies within half of it is near.
CELL = 0.02
#: Pairs of names less alike are no candidates.
LEAST = 0.6
FEATURES = ["alike", "kept", "clash", "thin", "rivals", "same_commune", "other_commune", "same_dep", "near", "far", "same_ape", "other_ape"]

# Words that name nobody; an employer named by nothing else stays unnamed, as do rows of X.
NOBODY = "NON COMMUNIQUE COMMUNIQUEE RENSEIGNE RENSEIGNEE PRECISE PRECISEE DIVULGUE ANONYME CONFIDENTIEL CONFIDENTIELLE INCONNU INCONNUE EMPLOYEUR ENTREPRISE SOCIETE RECRUTEUR CLIENT NOTRE UN UNE NOM N C NC NR ND".split()


def _scored(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(fa, fb, score, kept, thin) of pairs of names at least LEAST alike. words: (f, word, weight, trusted), arrays in order."""

    def lists(a: pa.ListArray) -> list[list]:
        """Its arrays as lists, all values converted at once: an array of NumPy for each costs more than the alignment."""
        at, values = a.offsets.to_numpy(), a.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = (at - at[0]).tolist() if len(at) else []
        return [values[i:j] for i, j in pairwise(ends)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            aligned = [align(x, y) for x, y in zip(*[zip(*[lists(b[c + s]) for c in "xyt"]) for s in "ab"])]
            alike = [i for i, (share, _, _) in enumerate(aligned) if share >= LEAST]
            score, kept, thin = zip(*[aligned[i] for i in alike]) if alike else ((), (), ())
            ids = b.select(["fa", "fb"]).take(pa.array(alike, pa.int64()))
            yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(score, pa.float64()), pa.array(kept, pa.bool_()), pa.array(thin, pa.bool_())], ["fa", "fb", "score", "kept", "thin"])

    side = lambda s: words.select(F.col("f").alias("f" + s), F.col("word").alias("x" + s), F.col("weight").alias("y" + s), F.col("trusted").alias("t" + s))
    return pairs.join(side("a"), "fa").join(side("b"), "fb").mapInArrow(run, "fa long, fb long, score double, kept boolean, thin boolean")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Coefficients (the constant last) of a ridge logistic regression by Newton's steps; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    c, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ c)
        c += step
        if np.abs(step).max() < 1e-6:
            break
    return c


def fit_platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Calibration of scores z by a logistic curve a * z + b, with the shares of the labels as they are; a is positive."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([z, np.ones(len(z))], axis=1)
    c = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p))
        c = c + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(c[0]), 0.05), float(c[1])


def _named(df: DataFrame, name: str) -> DataFrame:
    """(h, f, core, kinds) of the distinct non-null values of a column of names: their hash, their core words with the
    hash of these, and the kinds of activity they tell. Names of no core word or that name nobody are left out."""
    # written once: else the optimizer puts the normalization of every row, and again of every filter, before the distinct
    forms = materialize(df.where(F.col(name).isNotNull()).select(name).distinct().select(F.xxhash64(name).alias("h"), normalized(F.col(name)).alias("n")), "normalized")
    forms = forms.select("h", F.split("n", " ").alias("words"))
    nobody = F.forall("words", lambda w: w.isin(*NOBODY) | w.rlike("^X+$"))
    core = F.array_join(F.filter("words", is_core), " ").alias("core")
    out = forms.where(~nobody).select("h", core, activity_classes(F.col("words")).alias("kinds")).where(F.col("core") != "")
    return out.select("h", F.xxhash64("core").alias("f"), "core", "kinds")


def alike_names(typed: DataFrame, official: DataFrame, typed_places: DataFrame, official_places: DataFrame) -> DataFrame:
    """(fa, fb, score, kept, thin): the typed and official names that an alignment of their words makes alike.
    typed, official: (f, core), one row a name; places: (f, place).

    Blocking: names meet by hashed elements of several attributes (pairs of words, a word with another's initial, a
    word with the place), in which mistyped words count as the official words near them (symmetric-delete index)."""
    forms = materialize(typed.withColumn("t", F.lit(False)).unionByName(official.withColumn("t", F.lit(True))).groupBy("f").agg(F.first("core").alias("form"), F.max("t").alias("official"), F.min("t").alias("only")), "forms")
    n = forms.count()
    split = forms.select("f", "official", F.posexplode(F.array_distinct(F.split("form", " "))).alias("pos", "word"))
    weight = lambda df: F.log(F.lit(float(n + 1)) / df)
    df = split.groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.max("official").alias("trusted"))
    # as a key, a word of no official name meets none: it is null
    key = lambda k: F.when(F.col("trusted") | (k["word"] != F.col("word")), k["word"])
    index = word_index(df, trusted_only=True).withColumns({"weight": weight(F.col("df")), "keys": F.transform("keys", lambda k: F.struct(key(k).alias("word"), weight(k["df"]).alias("weight")))})
    index = materialize(index, "words")
    words = split.join(index.select("word", "weight", "trusted"), "word").groupBy("f").agg(F.sort_array(F.collect_list(F.struct("pos", "word", "weight", "trusted"))).alias("w"))
    words = materialize(words.select("f", "w.word", "w.weight", "w.trusted"), "weighed")
    rare = rarity(n)
    # an official name that is also typed is on both sides
    rows = materialize(word_rows(forms, index, "official", "only"), "rows")
    mine = rows.where(~F.col("only")).drop("official", "only")
    theirs = rows.where("official").where("own").drop("official", "only")
    short_a, short_b = (materialize(shortened(x, rare), "initials") for x in (mine, theirs))
    a = elements(mine, rare, typed_places).unionByName(short_a).unionByName(spelled(mine, rare, short_b))
    b = elements(theirs, rare, official_places).unionByName(short_b).unionByName(spelled(theirs, rare, short_a))
    pairs = candidates(materialize(a, "typed"), materialize(b, "official"))
    return _scored(pairs, words)


def match_entities(offers: DataFrame, firms: DataFrame, probability: float = 0.5) -> DataFrame:
    """(offre_id, siren, confidence): for each offer that names its employer the best firm of the register, with a
    calibrated probability; offers without a firm of at least that probability give no row.

    offers: offre_id, entreprise_nom, code_commune, departement, code_ape, latitude, longitude; firms: siren,
    raison_sociale, enseigne, code_commune, departement, code_ape, latitude, longitude; any version.

    Names that differ only in case, legal form, activity or abbreviations have the same core words and are searched
    once (alike_names). Offers and firms meet by their aligned names; agreement in commune, department, nearness and
    activity completes the features. Pairs that are plainly right (the very name, unique in the register, at a place
    of the firm) or plainly wrong label themselves; a bounded sample of them (SAMPLE) fits a logistic classifier, the
    held-out half calibrates it.

    All rows of an offer agree; repeated rows count once (of differing rows each is tried and the best match kept).
    Null, blank, withheld and word-less names give no match. Equal probabilities: the smaller siren. Between firms
    that nothing tells apart probabilities are shared. No labelled pairs (tiny or empty tables): the name score
    itself decides, with fixed coefficients. Extra columns don't matter."""
    clean = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    la, lo = F.col("latitude"), F.col("longitude")
    placed = la.isNotNull() & lo.isNotNull() & ~((la == 0) & (lo == 0)) & F.col("latitude").between(-90, 90)
    cx, cy = F.when(placed, F.floor(la / CELL * 2).cast("int")), F.when(placed, F.floor(lo / CELL * 2).cast("int"))  # half cells
    place = [clean("code_commune").alias("commune"), clean("departement").alias("dep"), clean("code_ape").alias("ape"), cx.alias("cx"), cy.alias("cy")]
    attributes = ["f", "kinds", "commune", "dep", "ape", "cx", "cy"]
    typed = materialize(_named(offers, "entreprise_nom").withColumn("told", F.col("kinds").cast("string")), "typed-names")
    both = firms.where(F.col("siren").isNotNull()).select("siren", F.explode(F.array("raison_sociale", "enseigne")).alias("name")).where(F.col("name").isNotNull())
    both = materialize(both.distinct(), "firm-rows")
    official = _named(both, "name")
    firm_of = materialize(both.select("siren", F.xxhash64("name").alias("h")).join(official, "h").select("f", "core", "kinds", "siren").distinct(), "firm-names")

    # offers with the same employer, place and activity are one mention
    by = F.xxhash64(*[F.coalesce(F.col("told" if c == "kinds" else c).cast("string"), F.lit("\u0001")) for c in attributes])
    said = offers.where(F.col("offre_id").isNotNull() & F.col("entreprise_nom").isNotNull()).select("offre_id", F.xxhash64("entreprise_nom").alias("h"), *place)
    said = said.join(typed.select("h", "f", "kinds", "told"), "h").select("offre_id", by.alias("mention"), *attributes)
    said = materialize(said, "offers")  # repeated rows fall together below
    m = materialize(said.drop("offre_id").distinct(), "mentions")
    sites = materialize(firms.where(F.col("siren").isNotNull()).select("siren", *place).distinct(), "sites")
    towns = sites.select("siren", F.col("commune").alias("place")).distinct()
    alike = materialize(
        alike_names(typed.select("f", "core").distinct(), firm_of.select("f", "core").distinct(), m.select("f", F.col("commune").alias("place")).distinct(), firm_of.select("f", "siren").distinct().join(towns, "siren").select("f", "place").distinct()), "alike"
    )

    known = firm_of.select(F.col("f").alias("fb"), F.col("kinds").alias("kb"), "siren")
    alone = known.groupBy("fb").agg(F.count_distinct("siren").alias("sirens"))
    pairs = m.withColumnsRenamed({"f": "fa", "kinds": "ka"}).join(alike, "fa").join(known.join(alone, "fb"), "fb")
    agree = ~((F.size("ka") > 0) & (F.size("kb") > 0) & ~F.arrays_overlap("ka", "kb"))
    best = F.max(F.struct("score", F.expr("int(fa = fb)").alias("exact"), "kept", agree.alias("agree"), (~F.col("thin")).alias("thick"), (-F.col("sirens")).alias("few")))
    pairs = pairs.groupBy("mention", "siren").agg(best.alias("s"), *[F.first(c).alias(c) for c in ("commune", "dep", "ape", "cx", "cy")])
    pairs = materialize(pairs.withColumn("pair", F.xxhash64("mention", "siren")), "pairs")

    # agreement with any site of the firm, by an equi-join of hashed facts: commune, department, activity, cells
    kinds = {"c": 1, "d": 2, "a": 4, "g": 8}
    fact = lambda kind, *c: F.when(F.col(c[0]).isNotNull(), F.struct(F.lit(kinds[kind]).alias("kind"), F.xxhash64(F.lit(kind), "siren", *[F.col(x) if isinstance(x, str) else x for x in c]).alias("fact")))
    known = [fact("c", "commune"), fact("d", "dep"), fact("a", "ape")]
    half = lambda c, i: F.floor((F.col(c) + i) / 2).cast("int")
    around = [F.when(F.col("cx").isNotNull(), F.struct(F.lit(kinds["g"]).alias("kind"), F.xxhash64(F.lit("g"), "siren", half("cx", i), half("cy", j)).alias("fact"))) for i in (-1, 1) for j in (-1, 1)]
    here_ = F.when(F.col("cx").isNotNull(), F.struct(F.lit(kinds["g"]).alias("kind"), F.xxhash64(F.lit("g"), "siren", half("cx", 0), half("cy", 0)).alias("fact")))
    facts = sites.select(F.explode(F.array(*known, here_)).alias("x")).where(F.col("x").isNotNull()).select("x.fact")
    asked = pairs.select("pair", F.explode(F.array(*known, *around)).alias("x")).where(F.col("x").isNotNull()).select("pair", "x.kind", "x.fact")
    agree = asked.join(facts, "fact", "left_semi").groupBy("pair").agg(F.bit_or("kind").alias("agreed"))
    agree = agree.select("pair", *[F.col("agreed").bitwiseAND(bit).cast("boolean").cast("int").alias(k) for k, bit in kinds.items()])
    yes = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    no = lambda c, known: ((F.coalesce(F.col(c), F.lit(0)) == 0) & F.col(known).isNotNull()).cast("double")
    rivals = F.log1p(F.greatest(F.count_if(F.col("s.score") >= 0.8).over(Window.partitionBy("mention")) - (F.col("s.score") >= 0.8).cast("int"), F.lit(0)))
    x = pairs.join(agree, "pair", "left").select(
        "mention", "siren", F.col("s.score").alias("score"), ((F.col("s.score") - LEAST) * 10).alias("alike"), F.col("s.exact").cast("double").alias("exact"), F.col("s.kept").cast("double").alias("kept"), (~F.col("s.agree")).cast("double").alias("clash"),
        (~F.col("s.thick")).cast("double").alias("thin"), rivals.alias("rivals"), yes("c").alias("same_commune"), no("c", "commune").alias("other_commune"), yes("d").alias("same_dep"), yes("g").alias("near"), no("g", "cx").alias("far"), yes("a").alias("same_ape"), no("a", "ape").alias("other_ape"), (F.col("s.few") == -1).alias("single"),
    )
    # weak labels: the very name, unique in the register, or much the same name at a place of the firm is right; a
    # name half alike elsewhere, another trade, an initial elsewhere, and what competes with a right one is wrong
    here = (F.col("same_commune") > 0) | (F.col("near") > 0)
    sure = F.col("single") & (F.col("clash") == 0) & (((F.col("exact") > 0) & (F.col("thin") == 0)) | ((F.col("score") >= 0.8) & here))
    x = materialize(x.withColumn("settled", F.max(sure).over(Window.partitionBy("mention"))), "features")
    wrong = ((F.col("score") < 0.75) & ~here) | (F.col("clash") > 0) & (F.col("other_ape") > 0) | ((F.col("thin") > 0) & (F.col("other_commune") > 0) & ~here) | (F.col("settled") & ~sure)
    label = F.when(sure, 1).when(wrong, 0)
    labelled = materialize(x.select(*FEATURES, label.alias("y"), F.xxhash64("mention", "siren").alias("h")).where(F.col("y").isNotNull()), "labelled")
    # a bounded sample of either label: the rows whose hash is under a bound that lets about so many through
    have = {r.y: r.n for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = F.lit(None).cast("double")
    for y, n in have.items():
        bound = F.when(F.col("y") == y, min(1.0, SAMPLE / 2 / n)).otherwise(bound)
    sample = labelled.where(F.shiftrightunsigned("h", 11) * 2.0**-53 <= bound).orderBy("h", *FEATURES).toPandas()
    coefficients, (slope, shift) = _fit(sample)
    z = sum((F.col(f) * float(c) for f, c in zip(FEATURES, coefficients)), F.lit(float(coefficients[-1]))) * slope + shift
    rated = x.withColumn("z", z).withColumn("p", 1 / (1 + F.exp(-F.least(F.greatest(F.col("z"), F.lit(-30.0)), F.lit(30.0)))))
    # at most one firm is right: probabilities that add up to more than one are shared
    w = Window.partitionBy("mention")
    first = Window.partitionBy("mention").orderBy(F.col("z").desc(), "siren")
    odds = F.exp(F.least(F.col("z"), F.lit(30.0)))
    rated = rated.withColumns({"p": F.when(F.sum("p").over(w) > 1, F.col("p") * odds / F.sum(odds).over(w)).otherwise(F.col("p")), "r": F.row_number().over(first)})
    chosen = rated.where((F.col("r") == 1) & (F.col("p") >= probability)).select("mention", "siren", F.col("p").alias("confidence"))
    out = said.select("offre_id", "mention").join(chosen, "mention")
    last = Window.partitionBy("offre_id").orderBy(F.col("confidence").desc(), "siren")
    return out.withColumn("r", F.row_number().over(last)).where(F.col("r") == 1).select("offre_id", "siren", "confidence")


def _fit(sample: pd.DataFrame) -> tuple[np.ndarray, tuple[float, float]]:
    """Coefficients and calibration from labelled pairs; fixed ones where either label is missing."""
    y = sample["y"].to_numpy(float) if len(sample) else np.zeros(0)
    if len(y) < 50 or not 0 < y.mean() < 1:
        return np.array([1.5, 0.3, -4.0, -1.0, -0.5, 2.0, -0.5, 0.5, 1.0, -0.5, 1.0, -0.5, -2.5]), (1.0, 0.0)
    x = sample[FEATURES].to_numpy(float)
    half = (sample["h"].to_numpy() & 1) == 0
    c = fit_logistic(x[half], y[half])
    held = ~half if 0 < y[~half].mean() < 1 else half
    return c, fit_platt(x[held] @ c[:-1] + c[-1], y[held])
