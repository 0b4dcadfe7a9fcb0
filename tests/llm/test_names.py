import random
from itertools import permutations

from galena.llm import names
from galena.llm.entities import match_entities
from galena.llm.spelling import variant_pairs
from pyspark.sql import functions as F


def test_assignment_is_optimal():
    r = random.Random(1)
    for _ in range(200):
        n, m = r.randint(1, 4), r.randint(1, 4)
        g = [[r.choice([0, r.random()]) for _ in range(m)] for _ in range(n)]
        short, wide = (g, m) if n <= m else ([list(c) for c in zip(*g)], n)
        best = max(sum(short[i][p[i]] for i in range(len(short))) for p in permutations(range(wide), len(short)))
        assert abs(names.assign(g, g)[0] - best) < 1e-9


def test_words():
    assert names.edit("MARTIN", "MATRIN", 2) == 1 and names.edit("AB", "ABCD", 1) == 2
    assert names.likeness("J", "JEAN") == 0.8 and names.likeness("PHAUJOND", "PAHUJOND") > 0.8
    assert names.likeness("DURAND", "DURANT", True) == 0 and names.likeness("DUPONT", "MARTIN") == 0


def test_normalized(spark):
    given = ["E.U.R.L. Dûpont & Fils", "M. Jean-Luc D.", "Sté d'avocats Lœb", None, "...", "étude"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, n string")
    assert [r[0] for r in df.orderBy("i").select(names.normalized(F.col("n"))).collect()] == ["EURL DUPONT FILS", "JEAN LUC D", "LOEB", "", "", "ETUDE"]


FIRMS = [f"{a}{b}" for a in ("BRAU", "CLE", "DOU", "FLA", "GRI", "JOU", "LAU", "MEL", "NOR", "PLE") for b in ("GORGUE", "NIEUVAL", "SPARD", "TELIN", "VROND")]


def test_variants(spark):
    rows = [
        (1, "SARL BRAUGORGUE MELTELIN AVOCATS", "r", "75001"), (2, "Braugorgue & Meltelin avts", "o", None), (3, "Meltelin Baugorgue", "o", "75001"), (4, "BRAUGORGUE M. AVOCATS", "o", "75001"),
        (5, "SARL BRAUGORGUE MELTELIN AVOCATS", "r", "13001"), (6, "BRAUGORGUE MELTELIN CONSTRUCTION", "r", "75001"),
        (7, None, "o", "75001"), (8, " ", "o", None), (9, "SARL", "o", "75001"), (10, "SARL", "o", "75001"), (11, "Z" * 20_000 + " " + "mot " * 300, "o", None), (2, "Braugorgue & Meltelin avts", "o", None),
    ]
    r = random.Random(1)
    rows += [(100 + i, f"CABINET {r.choice(FIRMS[1:25])} {r.choice(FIRMS[25:38])}", "r", "1") for i in range(150)]
    df = spark.createDataFrame(rows, "nom_id long, nom string, champ string, code_commune string").withColumn("form", F.lit("x"))
    got = {tuple(x) for x in variant_pairs(df, "nom_id", "nom", "code_commune", F.col("champ") == "r").collect()}
    small = {p for p in got if p[1] < 100}
    assert {(1, 3), (1, 4), (9, 10)} <= small
    assert not {(1, 5), (1, 6), (3, 5), (5, 6)} & small
    assert all(a < b for a, b in got)
    assert variant_pairs(df.limit(0), "nom_id", "nom", "code_commune", F.lit(True)).count() == 0


def _linked(spark, *given):
    """Pairs of positions of (name, official) that are linked, all at one place, among other official names."""
    r = random.Random(2)
    rows = [(i, n, "r" if o else "o", "1") for i, (n, o) in enumerate(given)]
    rows += [(100 + i, f"CABINET {r.choice(FIRMS[1:25])} {r.choice(FIRMS[25:38])}", "r", "2") for i in range(150)]
    df = spark.createDataFrame(rows, "nom_id long, nom string, champ string, code_commune string")
    return {tuple(x) for x in variant_pairs(df, "nom_id", "nom", "code_commune", F.col("champ") == "r").collect() if x[1] < 100}


def test_official_names_have_slips(spark):
    got = _linked(spark, ("SARL VRAIXTHAC BOUGRINAL AVOCATS", True), ("VRRAIXTHAC BOUGRINAL", True), ("TRONDNARD LAULLPEIX", True), ("TRRONDNARD LAAULLPEIX", True), ("Vraixthac & Bougrinal", False))
    assert got == {(0, 1), (2, 3), (0, 4), (1, 4)}
    # two slips in either word of official spellings are two names
    assert _linked(spark, ("STESZIEUVAL PAIMEROLLE", True), ("PASSEROLLE STENIEUVAL", True)) == set()


def test_near_neighbours_hide_no_other(spark):
    # REZULIN is one letter off REBULIN, RAIBULIN two
    got = _linked(spark, ("PHALJOUZAT REBULIN", True), ("Phaljouzat Raibulin", False), ("GOUSTEIX REZULIN", True), ("CORDAVIX GREBULIN", True))
    assert got == {(0, 1)}


def _matched(spark, names, typed):
    firm = lambda i, n: (f"{i:09d}", n, None, f"{i:05d}", "01", "69.10Z", 45 + i / 10, 2.0)
    firms = [firm(i, n) for i, n in enumerate(names)] + [firm(1000 + i, f"{FIRMS[i % 50]} {FIRMS[(i * 7 + 11) % 50]}") for i in range(60)]
    offers = [(f"o{i}", n, f"{at:05d}", "01", "69.10Z", 45 + at / 10, 2.0) for i, (n, at) in enumerate(typed)]
    rest = "code_commune string, departement string, code_ape string, latitude double, longitude double"
    got = match_entities(spark.createDataFrame(offers, f"offre_id string, entreprise_nom string, {rest}"), spark.createDataFrame(firms, f"siren string, raison_sociale string, enseigne string, {rest}"))
    return {(r.offre_id, int(r.siren)) for r in got.collect()}


def test_one_word_names_have_slips(spark):
    assert _linked(spark, ("Treujuln Conseils", False), ("TREUJULIN CONSEILS", True)) == {(0, 1)}
    assert _matched(spark, ["TREUJULIN CONSEILS", "PHALJOUZAT REBULIN"], [("Treujuln Conseils", 0), ("Phaljouzat", 1)]) == {("o0", 0), ("o1", 1)}


def test_entities(spark):
    r = random.Random(7)
    firms = [(f"{i:09d}", f"SARL {FIRMS[i % 50]} {FIRMS[(i * 7 + 11 + i // 50) % 50]} AVOCATS", None, f"{i % 40:05d}", f"{i % 40:05d}"[:2], "69.10Z", 45 + i / 100, 2.0) for i in range(150)]
    firms += [firms[0], ("999999999", None, None, None, None, None, None, None), (None, "X", None, None, None, None, None, None)]
    f = spark.createDataFrame(firms, "siren string, raison_sociale string, enseigne string, code_commune string, departement string, code_ape string, latitude double, longitude double")
    offers, truth = [], {}
    for i in range(300):
        s, name, _, com, dep, ape, la, lo = firms[r.randrange(150)]
        words = name.split()[1:3]
        w = list(words[0])
        k = r.randrange(1, len(w) - 1)
        if i % 3 == 0:
            w[k], w[k + 1] = w[k + 1], w[k]
        offers.append((f"o{i}", f"{''.join(w)} & {words[1]} avocats".title(), com if i % 4 else None, dep if i % 4 else None, ape, la if i % 5 else None, lo, "clash"))
        truth[f"o{i}"] = s
    offers += [("none", None, "00001", "00", "69.10Z", 45.0, 2.0, ""), ("blank", " ", "00001", "00", "69.10Z", 45.0, 2.0, ""), ("held", "Anonyme", None, None, None, None, None, ""), ("other", "Boulangerie Inconnue Zzyzx", "00001", None, None, None, None, ""), (None, "x", None, None, None, None, None, ""), ("long", "mot " * 5000, None, None, None, None, None, ""), offers[0]]
    o = spark.createDataFrame(offers, "offre_id string, entreprise_nom string, code_commune string, departement string, code_ape string, latitude double, longitude double, siren string")
    got = {x.offre_id: (x.siren, x.confidence) for x in match_entities(o, f).collect()}
    right = sum(got.get(k, (None,))[0] == v for k, v in truth.items())
    assert right >= 0.9 * len(truth) and sum(got[k][0] != truth.get(k) for k in got) <= 0.05 * len(truth)
    assert not {"none", "blank", "held", "other"} & set(got) and all(0.5 <= c <= 1 for _, c in got.values())
    assert match_entities(o.limit(0), f).count() == 0 and match_entities(o, f.limit(0)).count() == 0
