import random

from galena.llm import blocks, names
from pyspark.sql import functions as F


def test_long_words_meet_by_their_parts():
    r = random.Random(3)
    for _ in range(300):
        a = "".join(r.choice("ABCDEFG") for _ in range(r.randint(33, 60)))
        b = list(a)
        for _ in range(2):
            i = r.randrange(len(b) - 1)
            match r.randrange(4):
                case 0:
                    b[i] = "Z"
                case 1:
                    del b[i]
                case 2:
                    b.insert(i, "Z")
                case _:
                    b[i], b[i + 1] = b[i + 1], b[i]
        b = "".join(b)
        assert set(names._part_keys(a)[1]) & set(names._part_keys(b)[0]) and set(names._part_keys(b)[1]) & set(names._part_keys(a)[0])


def test_word_index_finds_all_near_words(spark):
    r = random.Random(4)
    words = {"".join(r.choice("ABE") for _ in range(r.randint(3, 9))) for _ in range(250)} | {"LANGWORT" * 5, "LANGWORT" * 4 + "LANGWROX", "X1Y2"}
    df = spark.createDataFrame([(w, 1, False) for w in sorted(words)], "word string, df long, trusted boolean")
    got = {(x.word, k["word"]) for x in names.word_index(df).collect() for k in x["keys"]}
    near = {(a, b) for a in words for b in words if a == b or (min(len(a), len(b)) >= 4 and not any(c.isdigit() for c in a + b) and names.edit(a, b, 2) <= (1 if min(len(a), len(b)) < 7 else 2))}
    assert near <= got


def test_hot_blocks_lose_no_pair(spark):
    r = random.Random(5)
    rows = [(r.randrange(4), r.choice([0, 0, 0, 1, 2]), i) for i in range(160)]
    df = spark.createDataFrame(rows, "block long, side int, f long").distinct()

    def brute(a, b, alone):
        ok = lambda x, y: (x == y == 0) or {x, y} == {1, 2}
        pairs = {(p[2], q[2]) for p in a for q in b if p[0] == q[0] and ok(p[1], q[1]) and p[2] != q[2]}
        return {(min(p), max(p)) for p in pairs} if alone else pairs

    for most in (2000, 7):
        assert {tuple(x) for x in blocks.candidates(df, most=most).collect()} == brute(rows, rows, True)
        a, b = df.where("f < 80"), df.where("f >= 80")
        assert {tuple(x) for x in blocks.candidates(a, b, most).collect()} == brute([x for x in rows if x[2] < 80], [x for x in rows if x[2] >= 80], False)


def test_rows_that_meet_equals_join(spark):
    a = spark.createDataFrame([(1 if i < 60 else i, None if i == 99 else "p", i) for i in range(100)], "k long, at string, a long")
    b = a.withColumnRenamed("a", "b")
    want = sorted(map(tuple, a.join(b, ["k", "at"]).select("a", "b").collect()))
    assert sorted(map(tuple, blocks.rows_that_meet(a, b, ["k", "at"], 9).select("a", "b").collect())) == want == sorted(map(tuple, blocks.rows_that_meet(a, b, ["k", "at"]).select("a", "b").collect()))
    assert blocks.rows_that_meet(a.where(F.lit(False)), b, ["k", "at"]).count() == 0
