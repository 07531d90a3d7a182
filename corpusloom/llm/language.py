"""Whether a text is English, by letters: two trigram models of words fitted on labelled documents.

One model is fitted on documents labelled English, one on those labelled
otherwise; a first pair of models drops documents whose label it contradicts,
since labels are not free of error, and a second pair is fitted on the rest.
Fitting takes at most ``MAX_DOCUMENTS`` labelled documents of each kind, in order
of a hash of their ids; every document is judged.

Defined results: without labels of both kinds every word is taken for English;
NULL and empty texts have no words and are not English; labels that are NULL are
none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage

#: Most labelled documents of each kind that the models are fitted on.
MAX_DOCUMENTS = 1500
#: Words whose scores a Python worker remembers.
WORDS = 300_000


def trigrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


class WordScores(dict):
    """Word in lower case -> log odds of its letters in English and elsewhere, None without a letter; counted once per worker."""

    def __init__(self, english: dict[str, int], other: dict[str, int]):
        super().__init__()
        kinds = len({*english, *other}) + 1
        rates = [{g: n + 0.5 for g, n in m.items()} for m in (english, other)]
        totals = [sum(m.values()) + 0.5 * kinds for m in rates]
        self.fitted = bool(english and other)
        self.odds = {g: math.log(rates[0].get(g, 0.5) / totals[0]) - math.log(rates[1].get(g, 0.5) / totals[1]) for g in {*english, *other}} if english and other else {}
        # letters that neither has seen are rather not those of the better known one
        self.unseen = min(0.0, math.log(totals[1]) - math.log(totals[0])) if self.fitted else 1.0

    def __missing__(self, word: str) -> float | None:
        if len(self) >= WORDS:
            self.clear()
        inner = "".join(c for c in word if c.isalpha() or c in "'’-").strip("'’-")
        value = sum(self.odds.get(g, self.unseen) for g in trigrams(inner)) / (len(inner) or 1) if any(map(str.isalpha, inner)) else None
        if len(word) <= 60:
            self[word] = value
        return value

    def __reduce__(self):
        return _restored, (self.odds, self.unseen, self.fitted)


def _restored(odds: dict[str, float], unseen: float, fitted: bool) -> WordScores:
    out = WordScores({}, {})
    out.odds, out.unseen, out.fitted = odds, unseen, fitted
    return out


def score(counts: Counter, scores: WordScores) -> float:
    """Mean log odds of the words of a text; above 0 it is English."""
    total = size = 0.0
    for word, k in counts.items():
        s = scores[word]
        if s is not None:
            total += k * s
            size += k
    return total / size if size else 0.0


def _counted(sample: DataFrame, scores: WordScores | None) -> WordScores:
    """Models counted over the sample, less the documents whose label ``scores`` contradicts."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = (Counter(), Counter())
        for frame in frames:
            for text, english in zip(frame["text"], frame["english"]):
                own = Counter(text.lower().split())
                if scores is None or not scores.fitted or (score(own, scores) > 0) == english:
                    words[0 if english else 1].update(own)
        grams = (Counter(), Counter())
        for w, g in zip(words, grams):
            for word, k in w.items():
                inner = "".join(c for c in word if c.isalpha() or c in "'’-").strip("'’-")
                if inner:
                    for t in trigrams(inner):
                        g[t] += k
        both = sorted({*grams[0], *grams[1]})
        yield pd.DataFrame({"gram": pd.Series(both, dtype=object), "english": [grams[0][t] for t in both], "other": [grams[1][t] for t in both]})

    sums = sample.mapInPandas(count, "gram string, english bigint, other bigint").groupBy("gram").agg(F.sum("english").alias("english"), F.sum("other").alias("other"))
    # trigrams of at most 2 * MAX_DOCUMENTS documents
    rows = sums.collect()
    return WordScores({r.gram: r.english for r in rows if r.english}, {r.gram: r.other for r in rows if r.other})


def fitted(documents: DataFrame, most: int = MAX_DOCUMENTS) -> WordScores:
    """Scores of words from documents (doc_id, text, lang)."""
    if "lang" not in documents.columns:
        return WordScores({}, {})
    known = documents.where("doc_id is not null and trim(lang) <> ''")
    known = known.select("doc_id", F.lower(F.trim("lang")).startswith("en").alias("english"))
    first = lambda english: known.where(F.col("english") == english).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    ids = first(True).unionAll(first(False))
    sample = stage(documents.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id").select("text", "english"), "languages")
    return _counted(sample, _counted(sample, None))
