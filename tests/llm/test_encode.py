import random
import string

import pytest

from corpusloom.llm import encode as E

DOC = "doc_id bigint, text string, ids int, tk string"


@pytest.fixture(scope="module")
def plain():
    return E.Encoder(E.TOKENIZER).encode


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choice(string.ascii_letters + "éß漢 '’") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\n", "\t", " ", "\r\n", " \n ", ".", "\x1c", " 12"]) for _ in range(n))
    shared = [text(300) for _ in range(3)]
    out = [(i, text(rng.randrange(0, 200)) + rng.choice([*shared, ""]) + text(rng.randrange(0, 100))) for i in range(60)]
    return [*out, (60, None), (61, ""), (62, "   "), (63, "x" * 300_000), (64, "a b " * 60_000), (65, shared[0]), (66, shared[0]), (66, shared[0]), (67, "<|endoftext|> it's 3.14"), (None, shared[1])]


def test_exact_round_trip(spark, plain):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOC)
    got = E.encode_corpus(df, bits=6).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), plain(t) if t else []) for i, t in rows)
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want
    assert E.encode_corpus(df.limit(0)).count() == 0


def test_counts_and_words(spark, plain):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in corpus()], DOC)
    for r in df.withColumn("n", E.token_count(df.text)).collect():
        assert r.n == (len(plain(r.text)) if r.text else 0)


def test_equal_stretches_are_cut_alike():
    rng = random.Random(1)
    a = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    cuts = lambda t, shift: {int(c) - shift for c in E.cut_points(t, 6)[0]}
    one, two = cuts(a, 0), cuts("prefix of another length " + a, 25)
    assert {c for c in one if c > E.WINDOW} == {c for c in two if c > E.WINDOW} and len(one) > 20
