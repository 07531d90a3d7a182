"""Reading level of documents.

Sentences of prose are told from citations, notes, headings and lists by form;
over them five classic formulas (Flesch-Kincaid, Gunning fog, SMOG, Coleman-
Liau, automated readability) give school grades from lengths of sentences and
words and from syllables, which hyphenation-style rules count. The estimate is
the median of the grades, and cut points fitted on a bounded sample of graded
documents put it on the scale of the labels. Which texts are English is told by
letters, see ``language``.

Defined results: NULL, empty and blank texts have no words and no grade; texts
that are not English or have fewer than ``least_words`` words are not graded by
``levels``; a text without a sentence of prose is graded over all of its words;
repeated rows are graded alike; without labels the cut points are the defaults.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import language
from corpusloom.llm.language import WordScores
from corpusloom.session import stage

LEAST_WORDS = 40
#: Most graded documents the cut points are fitted on.
MAX_LABELS = 5000
#: Grades that separate the levels where nothing is labelled.
DEFAULT_CUTS = (9.0, 14.0, 20.0)

# hyphenation-style rules on single words: vowels that are not spoken, and vowels that are spoken apart
_SILENT = [
    (re.compile(r"(?<=[a-z]{2}[^aeiouytd])ed$"), "d"),  # fin-ished, but need-ed
    (re.compile(r"(?<=[a-z][^aeiouyl])e$|(?<=[aeiouy]l)e$"), ""),  # es-tate and whole, but ta-ble
    (re.compile(r"(?<=[^aeiouyscxzgh])es$|(?<=[^sc]h)es$"), "s"),  # es-tates, but cas-es
    (re.compile(r"(?<=[a-z]{2})e(?=ly$|ment$|ments$|less$|ness$|ful$)"), ""),  # state-ment
]
_APART = [
    re.compile(r"(?<![tscg])i(?=[aou])"),  # so-ci-al is left to -cial; me-di-a
    re.compile(r"(?<=[^aeioqugy])u(?=[aeio])"),  # intellec-tu-al
    re.compile(r"(?<=[a-z])ism(?:s)?$"),  # -is-m
    re.compile(r"(?<=[^aeiouy])ying$|eing$|[aeo]ing$"),  # be-ing
]
_VOWELS = re.compile(r"[aeiouyäöüéèàáíóúêâîôû]+")
_TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_END = re.compile(r"([.!?][\"'”’)\]]*)\s+")
_SPLIT = re.compile(r"\x00|\n\s*\n\s*|\n(?=[-•*0-9\[(])")
_MARK = re.compile(r"(?<=[a-z][.!?,;:])(?:[0-9]{1,3}|\[[0-9]{1,3}\])(?=\s|$)")
_ENDED = re.compile(r"[.!?][\"'”’)\]]*$")
_DIGIT = re.compile(r"\d")
_STOP = re.compile(r"[.!?](?=\s|$)")
#: Words whose counts a Python worker remembers.
WORDS = 300_000


def syllables(word: str) -> int:
    """Syllables of a word in lower case; a compound has those of its parts."""
    if "-" in word or "'" in word or "’" in word:
        return sum(syllables(p) for p in re.split("[-'’]", word) if len(p) > 1) or 1
    spoken = word
    for pattern, repl in _SILENT:
        spoken = pattern.sub(repl, spoken)
    return max(1, len(_VOWELS.findall(spoken)) + sum(len(p.findall(word)) for p in _APART))


class WordTable(dict):
    """Word in lower case -> (syllables, letters); counted once per worker."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= WORDS:
            self.clear()
        letters = sum(c.isalpha() for c in word)
        value = (syllables(word) if letters else 0, letters)
        if len(word) <= 60:
            self[word] = value
        return value


_TABLE = WordTable()


def prose(text: str) -> list[str]:
    """Sentences of prose: several words in lower case and no figures, ended or items of a list."""
    out = []
    for s in _SPLIT.split(_END.sub("\\1\x00", _MARK.sub("", text.replace("\x00", " ")))):
        s = s.strip()
        if s and not _DIGIT.search(s) and (s[0] in "-•*" or _ENDED.search(s[-4:])) and sum(map(str.islower, s.split())) >= 4:
            out.append(s)
    return out


FEATURES = "n_words int, english double, sentences int, words int, syllables int, complex_words int, chars int"


def text_features(text: str | None, scores: WordScores) -> tuple:
    if not text:
        return 0, 0.0, 0, 0, 0, 0, 0
    # words between white space that have a letter or figure
    counts = Counter(text.lower().split())
    n_words = counts.total() - sum(k for w, k in counts.items() if not (w[0].isalnum() or w[-1].isalnum() or any(c.isalnum() for c in w)))
    share = language.score(counts, scores)
    if share <= 0:
        return n_words, share, 0, 0, 0, 0, 0
    sentences = prose(text)
    n = len(sentences) if sentences else max(1, len(_STOP.findall(text)))
    counts = Counter(_TOKEN.findall((" ".join(sentences) if sentences else text).lower()))
    words = syllables_ = complex_words = chars = 0
    for word, k in counts.items():
        y, c = _TABLE[word]
        if c:
            words += k
            syllables_ += k * y
            complex_words += k * (y >= 3)
            chars += k * c
    return n_words, share, n, words, syllables_, complex_words, chars


def features(documents: DataFrame, scores: WordScores) -> DataFrame:
    """doc_id with FEATURES; those of prose are 0 for texts that are not English.

    An Arrow UDF that counts every distinct word once per worker: regular
    expressions on the JVM, which see each occurrence anew, took ten times the
    CPU time.
    """

    @F.pandas_udf(FEATURES)
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_features(t, scores) for t in texts], columns=[c.split()[0] for c in FEATURES.split(", ")])

    return documents.select("doc_id", count("text").alias("_f")).select("doc_id", "_f.*")


def grade(df: DataFrame) -> DataFrame:
    """Adds the five grades and their median, ``grade``; NULL where there are no words."""
    w, s = F.when(F.col("words") > 0, F.col("words").cast("double")), F.when(F.col("sentences") > 0, F.col("sentences").cast("double"))
    per = w / s
    grades = {
        "flesch_kincaid": 0.39 * per + 11.8 * F.col("syllables") / w - 15.59,
        "fog": 0.4 * (per + 100 * F.col("complex_words") / w),
        "smog": 1.0430 * F.sqrt(30 * F.col("complex_words") / s) + 3.1291,
        "coleman_liau": 5.88 * F.col("chars") / w - 29.6 * s / w - 15.8,
        "automated": 4.71 * F.col("chars") / w + 0.5 * per - 21.43,
    }
    middle = F.sort_array(F.array(*[F.col(k) for k in grades]))[2]
    return df.withColumns(grades).withColumn("grade", middle)


def fit_cuts(graded: list[tuple[float, int]], levels: int = 4) -> tuple[float, ...]:
    """Cut points that put most labelled documents into their level (exact, by dynamic programming)."""
    rows = sorted((g, l) for g, l in graded if g is not None and l is not None and 1 <= l <= levels)
    if len(rows) < levels:
        return DEFAULT_CUTS
    best = [[0.0] * (len(rows) + 1) for _ in range(levels + 1)]
    back = [[0] * (len(rows) + 1) for _ in range(levels + 1)]
    # rows[:i] in levels up to k; a row off by d levels costs d
    inf = float("inf")
    for i in range(1, len(rows) + 1):
        best[0][i] = inf
    for k in range(1, levels + 1):
        run, start = inf, 0
        for i in range(len(rows) + 1):
            cost = abs(rows[i - 1][1] - k) if i else 0
            run += cost
            if best[k - 1][i] <= run:
                run, start = best[k - 1][i], i
            best[k][i], back[k][i] = run, start
    cuts, i = [], len(rows)
    for k in range(levels, 1, -1):
        i = back[k][i]
        low = rows[i - 1][0] if i else rows[0][0] - 1
        high = rows[i][0] if i < len(rows) else rows[-1][0] + 1
        cuts.append((low + high) / 2)
    return tuple(reversed(cuts))


def levels(documents: DataFrame, labels: DataFrame, least_words: int = LEAST_WORDS, max_labels: int = MAX_LABELS) -> DataFrame:
    """(doc_id, grade, level) of every English document of at least ``least_words`` words."""
    bound = labels.select("doc_id", "level").where("doc_id is not null and level is not null").dropDuplicates(["doc_id"])
    bound = bound.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    # staged, or the filter below would be pushed under the join and grade every document
    known = stage(documents.select("doc_id", "text").join(F.broadcast(bound), "doc_id"), "graded")
    scores = language.fitted(documents)
    known = grade(features(known, scores)).where(is_english()).join(F.broadcast(bound), "doc_id")
    cuts = fit_cuts([(r.grade, r.level) for r in known.select("grade", "level").collect()])
    out = grade(features(documents, scores).where(is_english() & (F.col("n_words") >= least_words)))
    level = F.lit(1)
    for c in cuts:
        level = level + F.coalesce(F.col("grade") > c, F.lit(False)).cast("int")
    return out.select("doc_id", "grade", level.alias("level"))


def is_english() -> Column:
    return F.col("english") > 0


def profile(graded: DataFrame) -> DataFrame:
    """Documents and mean grade by level."""
    return graded.groupBy("level").agg(F.count("*").alias("documents"), F.round(F.avg("grade"), 3).alias("mean_grade"))
