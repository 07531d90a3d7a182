"""Operators over notes and their labels.

Order comes from explicit positions; a document's notes or lines are the
largest group that any window or grouped function sees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

# What the beginning of a note and the words of one look like.
NOTE_START = r"^\s*(\d{1,4}|[ivxlcdm]{1,7}|[*†‡§¶])[\]).,:;-]?\s+(.+)$"
NOTE_LIKE = r"(?i)^\s*(?:\[\^\d{1,4}\]:|\d{1,4}[\]).,:;-]?\s+|[ivxlcdm]{1,7}[\]).,:;-]?\s+|[*†‡§¶]\s+)"
LEGAL_SIGNAL = r"(?i)\b(?:v\.|u\.s\.|f\.\d|s\. ct\.|id\.|supra|infra)"
SHORT_CITE = r"(?i)\b(?:id\.|ibid\.|supra|infra)"
AUTHOR_MARKERS = ("*", "†", "‡", "§", "¶")
#: What follows a number that is part of a wrapped citation and no label.
FRAGMENT = (
    r"(?i)^(?:\(?[0-9,\s–—-]+\)?\.?\s*$|at\s+[0-9]|[0-9]+[–—-][0-9]+\s*\(?(?:19|20)[0-9]{2}\)?\.?\s*$|[0-9]+,\s*[0-9]+\s*\([^)]+\)|\([0-9]+(?:st|nd|rd|th)\s+Cir\."
    r"|(?:U\.S\.?|F\.\s*(?:2d|3d|Supp\.?\s*(?:2d|3d)?)|S\.\s*Ct\.?)\s+(?:at\s+)?[0-9]|[0-9]+\s*\(\s*(?:[0-9]+(?:st|nd|d|rd|th)\s+Cir\.|(?:19|20)[0-9]{2}))"
)
#: Costs of missing labels between two notes, of any other break, and of counting from 1 again; a note opened is worth 1.
MISSING, ANY_BREAK, AGAIN = (0.0, 0.5, 1.5, 2.5), 3.0, 1.5
#: Missing labels a document may have, and the share of its span they may be beyond that.
GAP_TOLERANCE, GAP_SHARE = 2, 0.05
# When a label at an end of a list stands apart (members there have to be, times the median step or half the
# members, least distance, share of the greater label), what a chain of labels pays, what a candidate and a note are worth.
APART = {"steps": (4, 5, 8, 0.15), "members": (3, 0.5, 5, 0.25)}
CHAIN = {"late": 5.0, "upward": 10.0, "slack": 0.5, "again": 12.0, "missing": (0.0, 0.5, 1.5, 4.0, 4.0), "more": 2.0, "least": 0.1}
CANDIDATE = {"base": 1.0, "marked": 2.0, "below": 1.25, "above": -1.25, "legal": 2.0, "other": 1.5, "low_half": 0.5, "top_fifth": -1.0}
CONFIDENCE = {"base": 0.55, "long": (80, 0.2), "middling": (30, 0.1), "short": -0.1, "context": 0.1, "no_context": -0.15, "pages": 0.05, "flag": -0.1}


def notes_of(sidecars: DataFrame, *more: str) -> DataFrame:
    """One row per note with its position in the sidecar."""
    n = sidecars.select("pdf_id", "extractor_version", *more, F.posexplode("notes").alias("idx", "n"))
    return n.select("pdf_id", "extractor_version", *more, "idx", "n.*").withColumn("number", F.when(F.col("label").rlike(r"^[0-9]{1,6}$"), F.col("label").cast("int")))


def label_order(label: Column) -> Column:
    """Sort key: numbers before other labels."""
    number = F.when(label.rlike(r"^[0-9]{1,9}$"), label.cast("int"))
    return F.struct(number.isNull().alias("text"), F.coalesce(number, F.lit(0)).alias("n"), label.alias("label"))


def stands_apart(kept: list[int], outer: int, inner: int, rule: str, members: int) -> bool:
    """Whether the outermost label of a sorted list is a stray by one of the rules of APART."""
    least_members, factor, least, share = APART[rule]
    distance, scale = abs(kept[outer] - kept[inner]), max(kept[outer], kept[inner])
    if rule == "members":
        return distance > max(least, int(members * factor)) and distance > share * scale
    rest = sorted(set(kept) - {kept[outer]})
    usual = max(1, int(median(np.diff(rest)))) if len(rest) > 1 else distance
    return len(rest) > 1 and distance >= max(least, factor * usual) and distance > share * scale


def trim_outliers(labels: list[int]) -> list[int]:
    """Sorted distinct labels without isolated ones at either end.

    The distance of an outermost label to its neighbour is held against the
    usual step of the others and, where that says nothing, against the number of
    labels. At the lower end what is not positive goes as well. Every label that
    goes changes what the next is held against, hence no window.
    """
    kept = sorted(set(labels))
    if len(kept) < min(n for n, *_ in APART.values()):
        return kept
    for outer, inner in ((-1, -2), (0, 1)):
        for rule, (least_members, *_) in APART.items():
            members = len(kept)
            while len(kept) >= least_members and ((outer == 0 and kept[0] <= 0) or stands_apart(kept, outer, inner, rule, members)):
                del kept[outer]
    return kept


@F.pandas_udf(ArrayType(IntegerType()))
def trimmed(labels: pd.Series) -> pd.Series:
    return labels.map(lambda x: trim_outliers([int(v) for v in x]) if x is not None else [])


def ordinality(labels: Column, tolerance: int = GAP_TOLERANCE, share: float = GAP_SHARE) -> Column:
    """struct<status, low, high, gaps, ratio> of sorted distinct labels.

    Without labels or gaps the status is ``valid``; with more gaps than
    tolerated, and more than their share of the span, ``invalid``.
    """
    low, high = F.array_min(labels), F.array_max(labels)
    gaps = F.when(F.size(labels) > 0, F.array_except(F.sequence(low, high), labels)).otherwise(F.array().cast("array<int>"))
    span = F.coalesce(high - low + 1, F.lit(1))
    bad = (F.size(gaps) > tolerance) & (F.size(gaps) / span > share)
    status = F.when(F.size(gaps) == 0, "valid").when(bad, "invalid").otherwise("valid_with_gaps")
    return F.struct(status.alias("status"), F.coalesce(low, F.lit(0)).alias("low"), F.coalesce(high, F.lit(0)).alias("high"), gaps.alias("gaps"), (F.size(gaps) / span).alias("ratio"))


def document_labels(notes: DataFrame) -> DataFrame:
    return notes.groupBy("pdf_id", "extractor_version").agg(F.array_sort(F.collect_set("number")).alias("labels"))


def page_bounds(notes: DataFrame) -> DataFrame:
    """First and last page of every numbered label."""
    n = notes.where("number is not null and coalesce(page_start, 0) > 0")
    return n.groupBy("pdf_id", "extractor_version", "number").agg(F.min("page_start").alias("first_page"), F.max(F.greatest("page_start", F.coalesce("page_end", "page_start"))).alias("last_page"))


def gap_pages(notes: DataFrame, expand: int = 0) -> DataFrame:
    """Pages on which a missing label may stand: between the pages of its neighbours."""
    w = Window.partitionBy("pdf_id", "extractor_version").orderBy("number")
    b = page_bounds(notes).withColumns({"next": F.lead("number").over(w), "next_page": F.lead("first_page").over(w)}).where(F.col("next") > F.col("number") + 1)
    low, high = F.greatest(F.lit(1), F.col("last_page") - expand), F.col("next_page") + expand
    pages = F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array(low)))
    return b.select("pdf_id", "extractor_version", F.col("number").alias("after_label"), F.col("next").alias("before_label"), pages.alias("page"))


def relabelled(notes: DataFrame) -> DataFrame:
    """Notes numbered 1..N by place, with whether that changes the label."""
    w = Window.partitionBy("pdf_id", "extractor_version").orderBy("page_start", "page_end", "ordinal", "idx")
    return notes.withColumn("new_label", F.row_number().over(w)).select("pdf_id", "extractor_version", "idx", "label", "new_label", (F.coalesce(F.col("number"), F.lit(-1)) != F.col("new_label")).alias("changed"))


def junk_signals(notes: DataFrame) -> DataFrame:
    """(pdf_id, extractor_version, idx, signal): notes that look like artefacts.

    Empty notes, page numbers and volume stamps have no further signal.
    """
    t = F.trim(F.coalesce("text", F.lit("")))
    n = notes.select("pdf_id", "extractor_version", "idx", t.alias("t"))
    same = F.count("*").over(Window.partitionBy("pdf_id", "extractor_version", "t"))
    n = n.withColumn("same", same)
    t, cite = F.col("t"), F.col("t").rlike(SHORT_CITE)
    stop = F.when(t == "", "empty_note").when(t.rlike(r"^[\[(-]*\s*[0-9]{1,4}\s*[\])-]*\.?$"), "page_number_artifact").when(t.rlike(r"(?i)^\[?vol\.?\s*[0-9]+"), "vol_issue_stamp")
    more = F.array(F.when((F.length(t) < 15) & ~cite, "suspiciously_short"), F.when((F.col("same") >= 3) & (F.length(t) >= 60) & ~cite, "duplicate_text"))
    signals = F.when(stop.isNotNull(), F.array(stop)).otherwise(F.filter(more, lambda x: x.isNotNull()))
    return n.select("pdf_id", "extractor_version", "idx", F.explode(signals).alias("signal"))


def note_confidence() -> Column:
    """Score of a note by length, context, pages and flags, within 0 and 1."""
    c = CONFIDENCE
    size = F.length(F.trim(F.coalesce("text", F.lit(""))))
    flagged = F.size(F.array_intersect(F.coalesce("flags", F.array().cast("array<string>")), F.array(F.lit("ambiguous_context"), F.lit("missing_context"))))
    parts = [
        F.when(size >= c["long"][0], c["long"][1]).when(size >= c["middling"][0], c["middling"][1]).otherwise(c["short"]),
        F.when(F.coalesce("context_body", F.lit("")) != "", c["context"]).otherwise(c["no_context"]),
        F.when(F.col("page_end") > F.col("page_start"), c["pages"]).otherwise(0.0),
        flagged * c["flag"],
    ]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum(parts, F.lit(c["base"]))))


def merged_labels(notes: DataFrame) -> DataFrame:
    """One note per label: texts that add something appended in order, the last page, the least confidence, all flags."""
    order = F.sort_array(F.collect_list(F.struct("idx", F.coalesce("text", F.lit("")).alias("text"))))
    g = notes.groupBy("pdf_id", "extractor_version", "label").agg(order.alias("parts"), F.max("page_end").alias("page_end"), F.min("confidence").alias("confidence"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("flags")))).alias("flags"), F.count("*").alias("merged"))
    text = F.aggregate("parts", F.lit(""), lambda acc, x: F.when(x["text"] == "", acc).when(acc == "", x["text"]).when(acc.contains(x["text"]), acc).otherwise(F.concat(acc, F.lit(" "), x["text"])))
    return g.select("pdf_id", "extractor_version", "label", text.alias("text"), "page_end", "confidence", F.array_join("flags", "|").alias("flags"), "merged")


# --------------------------------------------------------------- segmentation
def note_lines(docs: DataFrame) -> DataFrame:
    """(pdf_id, seq, page, text) of note lines in reading order, spaces collapsed."""
    p = docs.select("pdf_id", F.posexplode("pages").alias("page_index", "p"))
    l = p.select("pdf_id", "page_index", F.col("p.page_number").alias("page"), F.posexplode("p.note_lines").alias("line", "l"))  # noqa: E741
    return l.select("pdf_id", "page_index", "line", "page", F.trim(F.regexp_replace("l.text", r"[\s\x{00A0}]+", " ")).alias("text"))


def opened(numbers: list[int | None]) -> list[int]:
    """Note of every line (0 before the first), for the numbers the lines of a document begin with.

    Numbers of wrapped citations stand between labels, so labels are the chain
    of most notes less its breaks, over the whole document; the start counts as
    label 0. Linear: a chain is gone on with from the best end at each of the
    few labels before, or after a break from the best end of all.
    """
    places = [i for i, v in enumerate(numbers) if v is not None]
    total, parent = [0.0] * len(places), [-1] * len(places)
    ends: dict[int, int] = {}
    top = -1
    for k, i in enumerate(places):
        n = numbers[i]
        total[k] = 1 - (MISSING[n - 1] if 1 <= n <= len(MISSING) else ANY_BREAK)
        ways = [(total[j] + 1 - cost, j) for gap, cost in enumerate(MISSING, 1) if (j := ends.get(n - gap)) is not None]
        if top >= 0:
            ways.append((total[top] + 1 - (AGAIN if n == 1 else ANY_BREAK), top))
        for value, j in ways:
            if value > total[k]:
                total[k], parent[k] = value, j
        if n not in ends or total[k] > total[ends[n]]:
            ends[n] = k
        if top < 0 or total[k] > total[top]:
            top = k
    out = [0] * len(numbers)
    while top >= 0:
        out[places[top]] = 1
        top = parent[top]
    return list(accumulate(out))


@F.pandas_udf(ArrayType(IntegerType()))
def note_numbers(numbers: pd.Series) -> pd.Series:
    return numbers.map(lambda x: opened([None if v is None or v != v else int(v) for v in x]))


def numbered(lines: DataFrame) -> DataFrame:
    """lines with ``n``: the number a line begins with, unless what follows makes it the rest of a citation; empty lines left out."""
    start = r"^([0-9]{1,4})[\]).,:;-]?\s+(\S.*)$"
    label, rest = F.regexp_extract("text", start, 1), F.regexp_extract("text", start, 2)
    return lines.where("text <> ''").withColumn("n", F.when((label != "") & ~rest.rlike(FRAGMENT), label.cast("int")))


def segmented(lines: DataFrame) -> DataFrame:
    """(pdf_id, note_no, label, page_start, page_end, text): lines gathered under the markers they follow.

    A marker opens a note where it belongs to the best chain of labels of its
    document (``opened``); what looks like the rest of a citation is no marker.
    Lines before the first marker belong to no note.
    """
    whole = numbered(lines).groupBy("pdf_id").agg(F.sort_array(F.collect_list(F.struct("page_index", "line", "page", "text", "n"))).alias("l"))
    whole = whole.withColumn("note", note_numbers(F.transform("l", lambda x: x["n"])))
    each = F.transform("l", lambda x, i: F.struct(F.col("note")[i].alias("note_no"), (F.col("note")[i] - F.when(i > 0, F.col("note")[F.greatest(i - 1, F.lit(0))]).otherwise(0)).alias("opens"), x.alias("x")))
    marked = whole.select("pdf_id", F.inline(each)).where("note_no > 0").select("pdf_id", F.col("note_no").cast("bigint").alias("note_no"), "opens", "x.*")
    body = F.when(F.col("opens") == 1, F.regexp_replace("text", r"^[0-9]{1,4}[\]).,:;-]?\s+", "")).otherwise(F.col("text"))
    g = marked.groupBy("pdf_id", "note_no").agg(F.max(F.when(F.col("opens") == 1, F.col("n"))).alias("label"), F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.sort_array(F.collect_list(F.struct("page_index", "line", body.alias("t")))).alias("parts"))
    text = F.array_join(F.filter(F.col("parts.t"), lambda t: t != ""), " ")
    return g.select("pdf_id", "note_no", "label", "page_start", "page_end", F.regexp_replace(text, r"(?<=[A-Za-z0-9_])- (?=[a-z])", "").alias("text"))


# ------------------------------------------------------------- label sequence
def longest_path(worth: np.ndarray, entry: np.ndarray, ways: Callable[[int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(value of the best path to each node, the node before or -1) over nodes in order.

    A path is worth its nodes less ``entry`` of the first and what ``ways(i)``
    says the step from each earlier node to node i costs.
    """
    total, before = worth - entry, np.full(len(worth), -1)
    for i in range(1, len(worth)):
        gain = total[:i] + worth[i] - ways(i)
        j = int(gain.argmax())
        if gain[j] > total[i]:
            total[i], before[i] = gain[j], j
    return total, before


@dataclass(frozen=True)
class ChainCosts:
    """What a chain of labels pays; the defaults are those of CHAIN."""

    late: float = CHAIN["late"]
    upward: float = CHAIN["upward"]
    slack: float = CHAIN["slack"]
    again: float = CHAIN["again"]
    missing: tuple[float, ...] = CHAIN["missing"]
    more: float = CHAIN["more"]

    def step(self, delta: np.ndarray) -> np.ndarray:
        """Cost of going ``delta`` labels on; none go back."""
        known = np.array([np.inf, *self.missing])
        far = self.missing[-1] + self.more * (delta - len(self.missing))
        return np.where(delta >= len(known), far, known[np.clip(delta, 0, len(known) - 1)])


def best_sequence(labels: list[int], pages: list[int], tops: list[float], scores: list[float], costs: ChainCosts = ChainCosts()) -> list[int]:
    """Indexes of the best chain of label candidates in reading order.

    A chain pays for starting late, for missing labels, for going up a page, and
    for starting again at 1 or 2 on a later page. Of equal chains the one with
    the greater last label wins, then the earlier. Quadratic in the candidates
    of one document, by arrays.
    """
    if not len(labels):
        return []
    value, page, top = np.array(labels), np.array(pages), np.array(tops, dtype=float)

    def ways(i: int) -> np.ndarray:
        forward = costs.step(value[i] - value[:i]) + costs.upward * ((page[:i] == page[i]) & (top[i] < top[:i] - costs.slack))
        if value[i] > 2:
            return forward
        return np.where(value[i] > value[:i], forward, np.where(page[:i] != page[i], costs.again, np.inf))

    total, before = longest_path(np.array(scores, dtype=float), costs.late * np.maximum(0, value - 1), ways)
    at, path = int(np.lexsort((-np.arange(len(value)), value, total))[-1]), []
    while at >= 0:
        path.append(at)
        at = int(before[at])
    return path[::-1]


CANDIDATES = "array<struct<page_index:int,line:int,top:double,label:int,score:double>>"


def candidate_lists(docs: DataFrame) -> DataFrame:
    """(pdf_id, c): per document the numbers that may be labels, at the start of body and note lines, with a score of their surroundings; built inside the row."""
    none = F.array().cast("array<struct<text:string,top:double,low:boolean>>")
    side = lambda p, name, low: F.coalesce(F.transform(p[f"{name}_lines"], lambda l: F.struct(l["text"].alias("text"), l["top"].alias("top"), F.lit(low).alias("low"))), none)
    w = CANDIDATE

    def scored(l: Column, i: Column, page_index: Column, height: Column) -> Column:  # noqa: E741
        t = l["text"]
        parts = [
            F.when(t.rlike(r"^\s*[0-9]{1,4}[\]).,:;-]"), w["marked"]).otherwise(0.0), F.when(l["low"], w["below"]).otherwise(w["above"]), F.when(t.rlike(LEGAL_SIGNAL), w["legal"]).otherwise(w["other"]),
            F.when(l["top"] >= 0.5 * height, w["low_half"]).when(l["top"] < 0.2 * height, w["top_fifth"]).otherwise(0.0),
        ]
        label = F.regexp_extract(t, r"^\s*([0-9]{1,4})", 1).cast("int")
        return F.struct(page_index.alias("page_index"), i.alias("line"), l["top"].alias("top"), label.alias("label"), F.greatest(sum(parts, F.lit(w["base"])), F.lit(CHAIN["least"])).alias("score"))

    def page(p: Column, k: Column) -> Column:
        lines = F.transform(F.concat(side(p, "body", False), side(p, "note", True)), lambda l, i: F.struct(l.alias("l"), i.alias("i")))
        return F.transform(F.filter(lines, lambda x: x["l"]["text"].rlike(r"^\s*[0-9]{1,4}[\]).,:;-]?\s+\S")), lambda x: scored(x["l"], x["i"], k, p["height"]))

    return docs.where("pages is not null").select("pdf_id", F.flatten(F.filter(F.transform("pages", page), lambda x: x.isNotNull())).cast(CANDIDATES).alias("c"))


def solved_labels(candidates: DataFrame) -> DataFrame:
    """(pdf_id, label, page_index, line) of the best chain of every document; no shuffle, since a document is a row."""

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for pdf_id, own in zip(frame["pdf_id"], frame["c"]):
                columns = [[x[k] for x in own] for k in ("label", "page_index", "top", "score", "line")]
                keep = best_sequence(columns[0], columns[1], [0.0 if t is None else t for t in columns[2]], columns[3])
                out += [(pdf_id, columns[0][i], columns[1][i], columns[4][i]) for i in keep]
            yield pd.DataFrame(out, columns=["pdf_id", "label", "page_index", "line"])

    return candidates.where("size(c) > 0").mapInPandas(solve, "pdf_id bigint, label int, page_index int, line int")
