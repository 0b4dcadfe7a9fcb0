"""Blocks of names: the elements by which names that may be the same meet, and the pairs that share one."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galena.llm.names import is_core
from galena.session import materialize

#: Two words make an element if chance alone would bring both into at most so many names.
CHANCE = 4.0
#: At most so many keys that are cut into slices are broadcast.
FEW_HOT = 10_000
#: Sides of an element: 0 meets 0; what has an initial or one word only (1) meets what is spelled out (2).
SAME, SHORT, SPELLED = 0, 1, 2


def rarity(names: int) -> float:
    """The least sum of two words' weights ln(names / names with the word) that makes them an element."""
    return max(math.log(names + 1) - math.log(CHANCE), 1.0)


def word_rows(forms: DataFrame, index: DataFrame, *more: str) -> DataFrame:
    """(f, pos, word, long, first, key, weight, own, more): one row per core word of a form and each of the words it is
    looked up under. Words and keys are 64-bit numbers. forms: (f, form, more); index: (word, keys: array<struct<word, weight>>),
    where a null word stands for the word itself without a key."""
    split = forms.select("f", *more, F.posexplode(F.array_distinct(F.split("form", " "))).alias("pos", "word")).where(is_core(F.col("word")))
    rows = split.join(index.select("word", "keys"), "word")
    w = rows.select("f", *more, "pos", F.xxhash64("word").alias("w"), (F.length("word") > 1).alias("long"), F.left("word", F.lit(1)).alias("first"), F.explode("keys").alias("k"))
    return w.select("f", "pos", F.col("w").alias("word"), "long", "first", F.when(F.col("k.word").isNotNull(), F.xxhash64("k.word")).alias("key"), F.col("k.weight").alias("weight"), (F.col("k.word").isNull() | (F.col("w") == F.xxhash64("k.word"))).alias("own"), *more)


def _keyed(words: DataFrame) -> DataFrame:
    """The rows that make elements: of words that are no initials, with a key. A word whose key is null only stands beside others."""
    return words.where(F.col("long") & F.col("key").isNotNull())


def _beside(x: DataFrame, y: DataFrame, rare: float, common: bool = False) -> DataFrame:
    """(f, block) of each rare word x, or if common of each that is not, beside the initial of another word y of its name."""
    enough = F.col("weight") < rare / 2 if common else F.col("weight") >= rare / 2
    met = _keyed(x).where(enough).select("f", "pos", "key").join(y.where("own").select("f", F.col("pos").alias("at"), F.col("first").alias("with")), "f")
    return met.where(F.col("pos") != F.col("at")).select("f", F.xxhash64(F.lit("initial"), "key", "with").alias("block"))


def shortened(words: DataFrame, rare: float, lone: bool = False) -> DataFrame:
    """(block, side, f) of names with an initial: another word with it; with lone also names of one word."""
    out = _beside(words, words.where(~F.col("long")), rare)
    if lone:
        single = words.groupBy("f").agg(F.count_distinct("pos").alias("n")).where(F.col("n") == 1).select("f")
        out = out.unionByName(_keyed(words).join(single, "f").select("f", F.xxhash64(F.lit("one"), "key").alias("block")))
    return out.select("block", F.lit(SHORT).alias("side"), "f")


def spelled(words: DataFrame, rare: float, short: DataFrame, lone: bool = False, symmetric: bool = False) -> DataFrame:
    """(block, side, f) of names that spell out what the names of short have an initial for, or not at all. symmetric:
    the names of short have every word near theirs among their keys, so that their own words are enough here."""
    out = _beside(words.where("own") if symmetric else words, words.where("long"), rare)
    if lone:
        out = out.unionByName(_keyed(words).where("own").select("f", F.xxhash64(F.lit("one"), "key").alias("block")))
    return out.join(short.select("block"), "block", "left_semi").select("block", F.lit(SPELLED).alias("side"), "f")


def _word_pairs(words: DataFrame, symmetric: bool) -> DataFrame:
    """(f, block, weight) of all pairs of a name's words that are no initials."""
    long = _keyed(words)
    side = lambda t, s: t.select("f", *[F.col(c).alias(c + s) for c in ("pos", "key", "weight", "own")])
    once = (F.col("posx") != F.col("posy")) & ~(F.col("ownx") & (F.col("posx") > F.col("posy"))) if symmetric else F.col("posx") < F.col("posy")
    met = side(long, "x").join(side(long.where("own") if symmetric else long, "y"), "f").where(once)
    return met.select("f", F.xxhash64(F.lit("pair"), F.least("keyx", "keyy"), F.greatest("keyx", "keyy")).alias("block"), (F.col("weightx") + F.col("weighty")).alias("weight"))


def common_elements(words: DataFrame, rare: float, sites: DataFrame) -> DataFrame:
    """(block, side, f) of what elements, shortened and spelled leave out because it is not rare, symmetric, for names
    that are told apart by place. sites: (f, place), the places of each name, null where it has rows without one.

    Names that share a place meet by each common element at that place, and a name without one meets every name with
    the element; so all names that share an element meet, but for those that no place can bring together."""
    short = materialize(_beside(words, words.where(~F.col("long")), rare, common=True), "common-initials")
    spelled_out = _beside(words.where("own"), words.where("long"), rare, common=True).join(short.select("block"), "block", "left_semi")
    pairs = _word_pairs(words, True).where(F.col("weight") < rare)
    kinds = ((pairs, SAME), (short, SHORT), (spelled_out, SPELLED))
    common = materialize(reduce(DataFrame.unionByName, [t.select("block", F.lit(side).alias("side"), "f") for t, side in kinds]), "common")
    at = common.join(sites.where(F.col("place").isNotNull()), "f").select(F.xxhash64("block", "place").alias("block"), "side", "f")
    lost = common.join(sites.where(F.col("place").isNull()).select("f"), "f", "left_semi")

    def sought(side: int, mine: list[int], other: int, theirs: list[int]) -> DataFrame:
        """The names without a place on one side, and all on the other that share an element with them."""
        x, y = lost.where(F.col("side").isin(mine)), common.where(F.col("side").isin(theirs))
        block = F.xxhash64("block", F.lit(f"sought {side}")).alias("block")
        return x.select(block, F.lit(side).alias("side"), "f").unionByName(y.join(x.select("block"), "block", "left_semi").select(block, F.lit(other).alias("side"), "f"))

    return at.unionByName(sought(SHORT, [SAME, SHORT], SPELLED, [SAME, SPELLED])).unionByName(sought(SPELLED, [SPELLED], SHORT, [SHORT]))


def elements(words: DataFrame, rare: float, places: DataFrame | None = None, symmetric: bool = False) -> DataFrame:
    """(block, side, f) of the names in word_rows: pairs of words; where places (f, place) are given, a word with the
    place; and for names without a rare pair all of their words.

    Whether a pair is rare hangs on the words that make the element, not on those of the name that gives it, so two
    names agree on it. symmetric: of two near words either has the other among its keys, so that one word of a pair
    by its keys beside the other as typed is enough. Names have few words: all pairs of a name's words are taken."""
    long = _keyed(words)
    owns = words.where(F.col("long") & F.col("own"))
    parts = [_word_pairs(words, symmetric).where(F.col("weight") >= rare).select("block", "f")]
    # names without a rare pair: all words, each in turn by its keys
    ws = F.sort_array(F.collect_list(F.struct("weight", "word")), asc=False)
    plain = owns.groupBy("f").agg(ws.alias("ws")).where((F.size("ws") == 1) | (F.col("ws")[0]["weight"] + F.col("ws")[1]["weight"] < rare)).select("f", F.col("ws.word").alias("ws"))
    turned = F.array_sort(F.transform("ws", lambda w: F.when(w == F.col("word"), F.col("key")).otherwise(w)))
    parts.append(long.join(plain, "f").select(F.xxhash64(F.lit("all"), turned).alias("block"), "f"))
    if places is not None:
        parts.append(long.join(places.where(F.col("place").isNotNull()), "f").select(F.xxhash64(F.lit("place"), "key", "place").alias("block"), "f"))
    return reduce(DataFrame.unionByName, parts).select("block", F.lit(SAME).alias("side"), "f")


def candidates(a: DataFrame, b: DataFrame | None = None, most: int = 2000) -> DataFrame:
    """Distinct (fa, fb) that share a block: of a and b, or of a alone (the smaller first). An initial's side meets
    the spelled one. Blocks of more than most names are cut into slices on both sides, each pair of slices a group of
    its own, so that none has to fit one task; nothing is dropped."""
    alone = b is None
    left = a.where(F.col("side") != SPELLED) if alone else a
    right = a.where(F.col("side") != SHORT) if alone else b
    left, right = left.select("block", F.col("side").alias("da"), F.col("f").alias("fa")), right.select("block", F.col("side").alias("db"), F.col("f").alias("fb"))
    meets = ((F.col("da") == SAME) & (F.col("db") == SAME)) | ((F.col("da") == SHORT) & (F.col("db") == SPELLED))
    if alone:
        meets = meets & (F.col("fa") != F.col("fb")) & ((F.col("da") == SHORT) | (F.col("fa") < F.col("fb")))
    else:
        meets = meets | ((F.col("da") == SPELLED) & (F.col("db") == SHORT))
    met = rows_that_meet(left, right, ["block"], most).where(meets)
    return met.select(F.least("fa", "fb").alias("fa"), F.greatest("fa", "fb").alias("fb")).distinct() if alone else met.select("fa", "fb").distinct()


def rows_that_meet(left: DataFrame, right: DataFrame, on: list[str], most: int = 5000) -> DataFrame:
    """The inner join of two frames on equal columns, where one key may hold a large share of the rows: keys with more
    than most rows on both sides, or on either of very many, are cut into a grid of slices and joined apart. Other
    column names must differ. Null keys meet nothing."""
    both = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    n = both.groupBy(*on).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr")).where((F.col("_nl") > 0) & (F.col("_nr") > 0) & (F.greatest("_nl", "_nr") > most))
    # computed once, on the executors: the driver gets their number, and of few a broadcast
    hot = materialize(n.select(*on, F.ceil(F.col("_nl") / most).cast("int").alias("_sl"), F.ceil(F.col("_nr") / most).cast("int").alias("_sr")), "hot")
    keys = hot.count()
    if not keys:
        return left.join(right, on)
    hot = F.broadcast(hot) if keys <= FEW_HOT else hot
    cold = left.join(hot.select(*on), on, "left_anti").join(right, on)

    def spread(t: DataFrame, own: str, other: str, cell) -> DataFrame:
        mine = F.pmod(F.xxhash64(*t.columns), F.col(own)).cast("int")
        t = t.join(hot, on).withColumn("_mine", mine).withColumn("_cell", F.explode(F.transform(F.sequence(F.lit(0), F.col(other) - 1), cell)))
        return t.drop("_sl", "_sr", "_mine")

    x = spread(left, "_sl", "_sr", lambda k: F.col("_mine") * F.col("_sr") + k)
    y = spread(right, "_sr", "_sl", lambda k: k * F.col("_sr") + F.col("_mine"))
    return cold.unionByName(x.join(y, [*on, "_cell"]).drop("_cell"))
