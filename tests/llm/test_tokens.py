import random

import pytest
from galena.llm import tokens
from galena.llm.tokens import Encoder, encode, token_counts

tokenizers = pytest.importorskip("tokenizers")


def reference():
    t = tokenizers.Tokenizer.from_file(tokens.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return t


def texts():
    r = random.Random(3)
    signs = "abcdefghij éàüßẞ日本語\n\t  '.,!?0123456789ABC😀’sxyzqthe ​"
    out = ["".join(r.choice(signs) for _ in range(r.randint(0, 120))) for _ in range(400)]
    out += ["", " ", "\n\n", "it's we'll I'M", "<|endoftext|>", "a" * 30_000, "ab" * 10_000, " " * 20_000, "xq" * 3000 + "é" * 5000, "naïve café — dès 39 €"]
    return out


def test_ids_equal_the_public_tokenizer():
    t = texts()
    ids, offsets = Encoder(tokens.VOCABULARY).encode(t)
    want = reference().encode_batch(t, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [w.ids for w in want]


def test_pair_check_agrees_with_merging():
    e, r = Encoder(tokens.VOCABULARY), random.Random(5)
    by = {v: k for k, v in e.ranks.items()}
    import numpy as np

    a, b = (np.array([r.randrange(20_000) for _ in range(1500)]) for _ in range(2))
    ok = e.compatible(a, b)
    for x, y, good in zip(a.tolist(), b.tolist(), ok.tolist()):
        assert (e._merge(by[x] + by[y], 1 << 30) == [x, y]) == good


def test_frame(spark):
    df = spark.createDataFrame([(1, "Bonjour le monde", 0), (2, None, 0), (3, "", 0), (1, "Bonjour le monde", 1)], "doc_id long, text string, ids int")
    rows = encode(df).collect()
    assert sorted((r.doc_id, len(r.ids)) for r in rows) == sorted((r.doc_id, r.n_tokens) for r in token_counts(df).collect())
    assert [r.ids for r in rows if r.doc_id in (2, 3)] == [[], []] and len(rows) == 4
    assert encode(df.limit(0)).count() == 0
