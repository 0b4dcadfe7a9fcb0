import random

import numpy as np
from galena.llm import blocks, names
from pyspark.sql import functions as F


def test_words_without_a_key_make_no_element(spark):
    """A word of no official name stands beside others, but costs no block that none can meet."""
    forms = spark.createDataFrame([(1, "PHALJOUZAT REBULIM"), (2, "PHALJOUZAT"), (3, "REBULIM")], "f long, form string")
    index = spark.createDataFrame([("PHALJOUZAT", [("PHALJOUZAT", 9.0)]), ("REBULIM", [(None, 9.0), ("REBULIN", 9.0)])], "word string, keys array<struct<word string, weight double>>")
    rows = blocks.word_rows(forms, index).cache()
    assert sorted((r.f, r.own, r.key is None) for r in rows.collect()) == [(1, False, False), (1, True, False), (1, True, True), (2, True, False), (3, False, False), (3, True, True)]
    got = blocks.elements(rows, 10.0, forms.select("f", F.lit("p").alias("place")))
    whole = blocks.elements(rows.withColumn("key", F.coalesce("key", "word")), 10.0, forms.select("f", F.lit("p").alias("place")))
    kept, all_ = {tuple(r) for r in got.collect()}, {tuple(r) for r in whole.collect()}
    # a pair with REBULIN, two places of form 1; all and place of form 2; the same by REBULIN of form 3
    assert kept < all_ and sorted(f for _, _, f in kept) == [1, 1, 1, 2, 2, 3, 3] and len(all_) == 11


def test_alike_is_within_the_distances(spark):
    r = random.Random(6)
    pairs = []
    for _ in range(3000):
        a = "".join(r.choice("ABCDE") for _ in range(r.randint(3, 11)))
        b = list(a)
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(b) - 1)
            b[i : i + 2] = r.choice([[b[i + 1], b[i]], [b[i], "F", b[i + 1]], [b[i]], [r.choice("ABCDE"), b[i + 1]]])
            if len(b) < 3:
                break
        pairs.append((a, "".join(b)))
    got = {(x.a, x.b) for x in spark.createDataFrame(pairs, "a string, b string").where(names._alike(F.col("a"), F.col("b"))).collect()}
    most = lambda a, b: 0 if min(len(a), len(b)) < 4 else 1 if min(len(a), len(b)) < 7 else 2
    near = {(a, b) for a, b in pairs if names.edit(a, b, 2) <= most(a, b)}
    assert near <= got and len(near) > 500


def test_alignment_is_the_same_of_lists_and_arrays():
    r = random.Random(7)
    for _ in range(500):
        sides = []
        for _ in "ab":
            x = r.sample(["PHALJOUZAT", "REBULIN", "REBULIM", "P", "R", "VANDROXE"], r.randint(1, 4))
            sides.append((x, [r.random() * 9 for _ in x], [r.random() < 0.5 for _ in x]))
        for doubt in (None, 0.1):
            assert names.align(*sides, doubt) == names.align(*[(x, np.array(w), t) for x, w, t in sides], doubt)
