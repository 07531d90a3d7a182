import random
from collections import Counter

from corpusloom.llm import language
from corpusloom.llm import readability as R
from corpusloom.llm.language import WordScores

EASY = "The dog ran to the park. The cat sat on the mat and it was warm. We had fun with the ball in the sun. "
HARD = "The institutionalization of constitutional jurisprudence notwithstanding, the commodification of intergenerational accountability presupposes that administrative particularization delegitimates every countermajoritarian referendum in contradistinction to the epistemological universalizability of the supranationality. "
GERMAN = "Der Hund lief in den Park und die Katze sass auf der Matte, denn es war nicht kalt und das Haus war gross. "


def test_levels(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(80):
        level = i % 4 + 1
        parts = [EASY] * (8 - 2 * level) + [HARD] * (2 * level - 2)
        rng.shuffle(parts)
        rows.append((i, "".join(parts) * 2, "x"))
        if i < 40:
            labels.append((i, level))
    rows += [(100, None, "x"), (101, "", "x"), (102, "   ", "x"), (103, GERMAN * 10, "en"), (104, "Too short to be graded.", "x"), (105, EASY * 3000, "x"), (106, "the of and to that with " * 20, "x"), (107, EASY * 10, "x"), (107, EASY * 10, "x")]
    german = [(200 + i, GERMAN * (i + 1), "x", "de" if i else "en") for i in range(6)]
    df = spark.createDataFrame([(*r, None if r[0] in (1, 105) else "de" if r[0] == 2 else "EN") for r in rows] + german, "doc_id bigint, text string, grade string, lang string")
    lab = spark.createDataFrame([*labels, (None, 3), (0, None), (999, 2)], "doc_id bigint, level int")
    got = R.levels(df, lab)
    by = {r.doc_id: r.level for r in got.collect()}
    assert all(by[i] == i % 4 + 1 for i in range(80))
    assert set(by) == {*range(80), 105, 106, 107} and by[105] == 1 and got.where("doc_id = 107").count() == 2
    assert R.levels(df, lab.limit(0)).count() == 84 and R.levels(df.limit(0), lab).count() == 0


def test_fit_cuts():
    rows = [(1.0, 1), (2.0, 1), (3.0, 2), (4.0, 2), (5.0, 3), (6.0, 3), (7.0, 4), (8.0, 4)]
    assert R.fit_cuts(rows) == (2.5, 4.5, 6.5)
    noisy = [*rows, (7.2, 4), (7.8, 4), (1.5, 2), (7.5, 1)]
    assert R.fit_cuts(noisy) == (2.5, 4.5, 6.5) and R.fit_cuts([]) == R.DEFAULT_CUTS


def test_counts(spark):
    df = spark.createDataFrame([(1, "The finished table was needed. The estates of constitutional nations are legal here.")], "doc_id bigint, text string")
    r = R.features(df, WordScores({}, {})).collect()[0]
    # the fin-ished ta-ble was need-ed | the es-tates of con-sti-tu-tion-al na-tions are le-gal here
    assert (r.sentences, r.words, r.syllables, r.complex_words) == (2, 13, 23, 1)


def test_language_with_wrong_labels(spark):
    """A tenth of wrong labels changes nothing; other scripts are not English; without labels of both kinds all is."""
    rng = random.Random(1)
    english, german = EASY.split() + HARD.split(), GERMAN.split() + "und die nicht ein Gericht Recht Vertrag schuldet dem Land eine Zahlung wegen Schadens".split()
    rows = []
    for i in range(200):
        own = i % 3 > 0
        lang = ("en-US" if own else "de-DE") if i % 10 else ("fr" if own else "en")
        rows.append((i, " ".join(rng.choice(english if own else german) for _ in range(60)), lang))
    df = spark.createDataFrame([*rows, (500, None, "en"), (501, "", "de"), (None, "x", "en")], "doc_id bigint, text string, lang string")
    scores = language.fitted(df)
    told = {i: language.score(Counter(t.lower().split()), scores) > 0 for i, t, _ in rows}
    assert all(told[i] == (i % 3 > 0) for i in told)
    assert language.score(Counter("это не английский текст".split()), scores) <= 0 and language.score(Counter(), scores) == 0
    free = language.fitted(df.where("lang like 'en%'"))
    assert language.score(Counter(["haus"]), free) > 0


def test_words_between_white_space(spark):
    """Forty words are counted between white space; a piece without letter or figure is none."""
    made = lambda n: "The dog ran to the park -- and sat . " * (n // 8)
    df = spark.createDataFrame([(1, made(40)), (2, made(32))], "doc_id bigint, text string")
    n = {r.doc_id: r.n_words for r in R.features(df, WordScores({}, {})).collect()}
    assert n == {1: 40, 2: 32}
