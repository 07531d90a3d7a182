"""Repair of text extracted from scanned and printed pages.

A hidden Markov model labels the lines of every page as running header, page
number, body or body that ends a paragraph. Its emissions are log-linear in
layout features (edge of the page, the page's own number, the same letters at
the edge of another page, type size, capitals, end of sentence, length). Sure
lines are seeds and counted over all documents; lines that may or may not be
headers are left open and shared out by expectation maximisation over the
pattern counts. The labels of the best path are the result. A header inside a
note is told by two Markov chains over classes of words, that of headers and
that of text, counted in the same pass. Broken words and misrecognised characters are judged
against the corpus's own words: every word has a *skeleton* under a homomorphism
that makes the usual confusions of recognition equal (rn = m, cl = d, ii = u,
1 = l ...), so that one equi-join finds the word meant, however many of its
characters are wrong. Words travel through shuffle joins; only the model's
parameters, a fixed number, reach the driver.

Defined results: NULL pages, line lists and texts have no lines and nothing is
found in them; an empty line is body; a document or a note given twice is
reported once; a hyphen at the end of the last line counts as broken where what
stands before it is no word of the corpus; the rest of a broken word is sought
on the same and the next page that has lines; empty tables give empty results.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, stage

HEADER, NUMBER, BODY, BREAK = range(4)
FEATURES = ["edge", "is_number", "has_number", "recurs", "small", "titled", "ended", "short", "note"]
EDGE, IS_NUMBER, HAS_NUMBER, RECURS, SMALL, TITLED, ENDED, SHORT, NOTE = (1 << i for i in range(9))
HYPHENS = "-‐­‑¬"

# What recognition takes for what. Equal images mean confusable
# characters: rn = m, cl = d, vv = w, ii = u = n, li = h = b, ti = n, t = l = i = 1.
SKELETON = {
    "a": "a", "b": "ii", "c": "c", "d": "ci", "e": "c", "f": "f", "g": "g", "h": "ii", "i": "i", "j": "j", "k": "k",
    "l": "i", "m": "rii", "n": "ii", "o": "o", "p": "p", "q": "q", "r": "r", "s": "s", "t": "i", "u": "ii", "v": "v",
    "w": "vv", "x": "x", "y": "y", "z": "z", "0": "o", "1": "i", "5": "s", "9": "g", "|": "i", "†": "i", "ﬁ": "fi", "ﬂ": "fi",
}


def skeleton(word: Column) -> Column:
    """Image of a lower-case word under the homomorphism of confusions."""
    single = {k: v for k, v in SKELETON.items() if len(v) == 1 and k != v}
    out = word
    # longer images first, in an order in which no image is rewritten again
    for k in ("m", "w", "ﬁ", "ﬂ"):
        out = F.replace(out, F.lit(k), F.lit({"m": "rn", "w": "vv", "ﬁ": "fi", "ﬂ": "fi"}[k]))
    out = F.regexp_replace(F.regexp_replace(out, "[bhnu]", "ii"), "d", "ci")
    keys = "".join(single)
    return F.translate(out, keys, "".join(single[k] for k in keys))


# ------------------------------------------------------------------ the lines
#: Not in parentheses and not in capital roman figures: those count items and sections.
_LIKE_NUMBER = re.compile(r"[^\w(]*(?:[Pp]age|PAGE|[Pp]g\.?|[Pp]\.)?\s*([0-9OoIl|](?:\s?[0-9OoIl|])*|[ivxlcdm]+)(?:\s*(?:of|/)\s*[0-9OoIl|]+)?[^\w)]*")
_DIGITS = str.maketrans("OoIl|", "00111")
_EDGE = re.compile(r"^[\[(]?([0-9OIl]{1,6})\b|\b([0-9OIl]{1,6})[\])]?\.?$")
_ENDED = re.compile(r"[.?!:][\"'”’)\]]*(?:[0-9]{1,3}|\[[0-9]{1,3}\])?$")
#: Characters after which no sentence has ended.
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyz,;-")
#: First characters with which no page number begins.
_NO_FIGURE = frozenset("abefghjknqrstuwyzABCDEFGHJKLMNQRSTUVWXYZ(")
_PIECE = re.compile(rf"([\w†ﬁﬂ'’:/.|-]*[\w†ﬁﬂ|])[{HYPHENS}]$")
_FIRST = re.compile(r"^[\W_]*?([\w†ﬁﬂ|][\w†ﬁﬂ'’|-]*)")
_BROKEN = re.compile(rf"([\w†ﬁﬂ'’:/.|-]*[\w†ﬁﬂ|])[{HYPHENS}] +([\w†ﬁﬂ|][\w†ﬁﬂ'’|-]*)")


def roman(n: int) -> str:
    out = ""
    for size, letters in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out, n = out + letters * (n // size), n % size
    return out


def is_page_number(text: str, page: int | None) -> bool:
    """Whether the line is nothing but the number of its page, however dressed."""
    if page is None or not text or not (m := _LIKE_NUMBER.fullmatch(text)):
        return False
    return _is_number(re.sub(r"\s", "", m[1]), page)


def _is_number(core: str, page: int) -> bool:
    """Whether figures, some of them misread, or a roman number are those of the page; a capital I alone counts a section."""
    figures = any(c.isdigit() for c in core) or set(core) == {"l"}
    return (figures and core.translate(_DIGITS) == str(page)) or (0 < page < 4000 and core == roman(page))


def unspaced(text: str) -> str:
    """Text that is set with a space after every letter, without those spaces."""
    words = text.split()
    if len(words) < 8 or sum(len(w) == 1 for w in words) < 0.7 * len(words):
        return text
    return re.sub(r"\s{2,}", " ", re.sub(r"(?<=\S) (?=\S)", "", text))


def has_page_number(text: str, page: int | None, note: bool = False) -> bool:
    """Whether a line begins or ends with the number of its page; what a note begins with is its label."""
    return page is not None and any((b if note else a or b).translate(_DIGITS) == str(page) for a, b in _EDGE.findall(text))


def titled(text: str) -> bool:
    """Words begin with capitals, as in headings."""
    words = [w for w in re.findall(r"[^\W\d_][\w'’-]*", text) if len(w) > 3]
    return bool(words) and sum(w[0].isupper() for w in words) >= 0.7 * len(words)


def _middle(values: np.ndarray):
    """Upper median."""
    return np.sort(values)[len(values) // 2]


_NO_LETTER = re.compile(r"[\W\d_]+")


def line_features(texts, sizes, pages, fonts, note: bool) -> np.ndarray:
    """Bits of FEATURES for the lines of one document's body or notes, flat in page order."""
    n = len(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    out = np.full(n, NOTE if note else 0, dtype=np.int16)
    if not n:
        return out
    known = fonts[~np.isnan(fonts)]
    if len(known):
        out[fonts < _middle(known) - 0.25] |= SMALL
    out[lengths < 0.72 * _middle(lengths)] |= SHORT
    # a mark of a note may follow the end of a sentence
    out[np.fromiter((t[-1:] in ".?!" and t != "" or (t[-1:] not in _PLAIN and _ENDED.search(t[-12:]) is not None) for t in texts), dtype=bool, count=n)] |= ENDED
    at, letters, owned = 0, [], []
    for leaf, (size, page) in enumerate(zip(sizes, pages)):
        end = at + size
        edges = range(at, end) if size <= 4 else (at, at + 1, end - 2, end - 1)
        own = set()
        for i in edges:
            edge = unspaced(texts[i].strip())
            bits = EDGE | (TITLED if titled(edge) else 0)
            if is_page_number(edge, page):
                bits |= IS_NUMBER
            elif has_page_number(edge, page, note):
                bits |= HAS_NUMBER
            out[i] |= bits
            if key := _NO_LETTER.sub("", edge.lower()):
                letters.append((i, leaf, key))
                own.add(key)
        owned.append(own)
        for i in range(at + 2, end - 2):
            if texts[i][:1] not in _NO_FIGURE and is_page_number(texts[i].strip(), page):
                out[i] |= IS_NUMBER
        at = end
    for i, leaf, key in letters:
        # the headers of left and right pages differ, so that of the next page or the one after counts
        if any(key in owned[k] for k in (leaf - 2, leaf - 1, leaf + 1, leaf + 2) if 0 <= k < len(owned)):
            out[i] |= RECURS
    return out


#: Label of lines that are no seeds.
OPEN = 4


def seed_labels(bits: np.ndarray) -> np.ndarray:
    """Labels of lines that are sure: what carries its page's number and recurs is a header, what is one of both is open."""
    has = lambda mask: (bits & mask) == mask
    sure = has(HAS_NUMBER | TITLED | RECURS) & ~has(NOTE)
    return np.select([has(IS_NUMBER), sure, has(HAS_NUMBER) | has(RECURS), has(ENDED | SHORT)], [NUMBER, HEADER, OPEN, BREAK], BODY)


#: Lines that one array of the model holds.
CELLS = 1 << 17


class LineModel:
    """Log probabilities: start (4), step (4 x 4), and per feature and state of being set (4 x 9)."""

    def __init__(self, counts: np.ndarray, steps: np.ndarray, rounds: int = 20, rarest: float = 1e-4, lost: float = 1e-3, made: float = 1e-6):
        """counts: lines by seed label or OPEN (5) and bits; steps: from seed to seed, the last rows being the starts of body and notes.

        Open lines are shared out over the labels, feature by feature, in
        ``rounds`` rounds of expectation maximisation. No step is taken for
        rarer than ``rarest``; no feature is lost more rarely than ``lost`` nor
        found where it is strange more rarely than ``made``.
        """
        bits = (np.arange(512)[:, None] >> np.arange(9)) & 1
        sure = counts[:4].astype(float)
        whole = sure.copy()
        for _ in range(rounds):
            n = whole.sum(axis=1, keepdims=True)
            on = np.clip((whole @ bits + 0.5) / (n + 1.0), made, 1 - lost)
            # a page number is nothing without its number
            on[NUMBER, FEATURES.index("is_number")] = 1 - made
            self.emit = np.log(on) @ bits.T + np.log(1 - on) @ (1 - bits.T)
            way = self.emit + np.log((n + 1) / (n.sum() + 4))
            share = np.exp(way - way.max(axis=0))
            whole = sure + counts[OPEN] * share / share.sum(axis=0)
        part = lambda table: np.log(np.maximum(rarest, (table + 1) / (table.sum(axis=-1, keepdims=True) + 4)))
        self.start, self.step = part(steps[4:]), part(steps[:4])

    def prefers(self, bits: int, label: int) -> bool:
        """Whether a line of these bits, wherever it stands, is rather of ``label`` than text."""
        return self.emit[label, bits] > max(self.emit[BODY, bits], self.emit[BREAK, bits])

    def label(self, bits: np.ndarray, sizes: list[int]) -> np.ndarray:
        """Viterbi over every page; pages of like length go together as one array."""
        bits, sizes = np.asarray(bits, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
        out, starts = np.full(len(bits), BODY, dtype=np.int8), np.cumsum(sizes) - sizes
        powers = np.frexp(np.maximum(sizes, 1).astype(float))[1]
        for power in np.unique(powers[sizes > 0]):
            group = np.flatnonzero((sizes > 0) & (powers == power))
            # at most CELLS lines at a time, whatever the batch
            step = max(1, CELLS >> int(power))
            for at in range(0, len(group), step):
                self._label(group[at : at + step], bits, sizes, starts, out)
        return out

    def _label(self, here, bits, sizes, starts, out) -> None:
        longest = sizes[here].max()
        places = starts[here][:, None] + np.minimum(np.arange(longest), sizes[here][:, None] - 1)
        live = np.arange(longest) < sizes[here][:, None]
        emit = self.emit.T[bits[places]]
        score, back = self.start[(bits[places[:, 0]] & NOTE) // NOTE] + emit[:, 0], np.zeros((len(here), longest, 4), dtype=np.int8)
        for t in range(1, longest):
            ways = score[:, :, None] + self.step
            back[:, t] = ways.argmax(axis=1)
            score = np.where(live[:, t, None], ways.max(axis=1) + emit[:, t], score)
        state = score.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            rows = live[:, t]
            out[places[rows, t]] = state[rows]
            state = np.where(rows, back[np.arange(len(here)), t, state], state)


def flat(docs: DataFrame) -> DataFrame:
    """One row per document with its lines as flat arrays, built inside the row."""
    none = F.array().cast("array<string>")
    side = lambda name: [
        F.flatten(F.transform("pages", lambda p: F.coalesce(p[f"{name}_lines"]["text"], none))).alias(f"{name}_texts"),
        F.flatten(F.transform("pages", lambda p: F.coalesce(p[f"{name}_lines"]["font_size"], F.array().cast("array<double>")))).alias(f"{name}_fonts"),
        F.transform("pages", lambda p: F.greatest(F.size(F.coalesce(p[f"{name}_lines"]["text"], none)), F.lit(0))).alias(f"{name}_sizes"),
    ]
    whole = docs.where("pages is not null").select("pdf_id", F.filter("pages", lambda p: p.isNotNull()).alias("pages"))
    number = F.transform("pages", lambda p: F.coalesce(p["page_number"], F.lit(-1)))
    scanned = F.transform("pages", lambda p: F.coalesce(p["source"], F.lit("text")) != "text")
    return whole.select("pdf_id", number.alias("numbers"), scanned.alias("scanned"), *side("body"), *side("note"))


def _sides(row) -> Iterator[tuple]:
    pages = [int(p) for p in row.numbers]
    asked = [p if p >= 0 else None for p in pages]
    for name in ("body", "note"):
        texts = ["" if t is None else t.replace("\n", " ") if "\n" in t else t for t in getattr(row, f"{name}_texts")]
        sizes = [int(s) for s in getattr(row, f"{name}_sizes")]
        fonts = np.array(getattr(row, f"{name}_fonts"), dtype=float)
        yield name, texts, sizes, pages, line_features(texts, sizes, asked, fonts, name == "note")


STUDY = (
    "kind string, pdf_id bigint, place string, sizes array<int>, numbers array<int>, bits array<smallint>, ends array<int>, pieces array<string>, firsts array<string>, "
    "i int, j int, n bigint, word string, clean bigint, scan bigint, clean_edge bigint, scan_edge bigint"
)
STUDY_COLUMNS = [c.rsplit(" ", 1)[0] for c in STUDY.split(", ")]
#: Distinct words a worker holds before it hands its counts on.
WORDS = 250_000
_TOKEN = re.compile(r"[^\W_]+(?:['’-]+[^\W_]+)*")
_LINE_FIRST = re.compile(r"(?m)^(?:[^\w\n]|_)*([^\W_]+(?:['’-]+[^\W_]+)*)")
_SPACES = frozenset(" \t\n\r\f\v")
#: Letters that stand for the two marks which recognition puts into words.
_DAGGER, _BAR = "\u01c2", "\u01c0"


def _study_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """All columns of STUDY, those not given being NULL."""
    frame = frame.astype(object)
    for c in STUDY_COLUMNS:
        if c not in frame:
            frame[c] = None
    return frame[STUDY_COLUMNS]


def word_text(text: str) -> str:
    """A text in lower case, with dagger and bar as letters."""
    text = text.lower()
    if "†" in text:
        text = text.replace("†", _DAGGER)
    if "|" in text:
        text = text.replace("|", _BAR)
    return text


def word_list(text: str) -> list[str]:
    """Words of a text in lower case, as words_of makes them."""
    return _TOKEN.findall(word_text(text))


def study(flats: DataFrame) -> DataFrame:
    """One pass over all lines; rows of three kinds.

    ``doc``: bits of FEATURES of a document's body or notes, its lines that end
    at a hyphen and, where there are any, the first words of its lines. ``count``
    and ``step``: lines by seed label and bits, and steps between seed labels.
    ``head`` and ``tail``: steps between the classes of words in sure headers,
    and in the first lines of notes on a page, which go on from the page before.
    ``word``: how often each word stands inside (clean, scan) and at the edges
    (clean_edge, scan_edge) of lines of print and of scans, combined per worker;
    a last word before a hyphen is a fragment and not counted.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        emit, step, chains = np.zeros((5, 512), dtype=np.int64), np.zeros((7, 5), dtype=np.int64), np.zeros((2, CLASSES, CLASSES), dtype=np.int64)
        # inside and at the edge, of print and of scans
        words = [Counter(), Counter(), Counter(), Counter()]

        def counted() -> pd.DataFrame:
            every = list(set().union(*words))
            own = {k: [max(0, c[w]) for w in every] for k, c in zip(("clean", "scan", "clean_edge", "scan_edge"), words)}
            for c in words:
                c.clear()
            return _study_rows(pd.DataFrame({"kind": "word", "word": [w.replace(_DAGGER, "†").replace(_BAR, "|") for w in every], **own}))

        for frame in frames:
            docs = []
            for row in frame.itertuples(index=False):
                for place, texts, sizes, pages, bits in _sides(row):
                    seeds = seed_labels(bits)
                    np.add.at(emit, (seeds, bits), 1)
                    long = np.asarray(sizes, dtype=np.int64)
                    first = np.zeros(len(bits), dtype=bool)
                    first[(np.cumsum(long) - long)[long > 0]] = True
                    np.add.at(step[4 + (place == "note")], seeds[first], 1)
                    inner = ~first[1:]
                    np.add.at(step, (np.where(seeds[:-1] < OPEN, seeds[:-1], 6)[inner], seeds[1:][inner]), 1)
                    for i in np.flatnonzero(first & (seeds > NUMBER) & (seeds < OPEN) if place == "note" else seeds == HEADER):
                        page = pages[np.searchsorted(np.cumsum(long), i, side="right")]
                        own = unspaced(texts[i].strip()).split()
                        # a line that begins with a label goes on with nothing
                        if own and not (place == "note" and _LABEL.match(own[0])):
                            path = [FROM, *word_classes(own, page), TO]
                            np.add.at(chains[int(place == "note")], (path[:-1], path[1:]), 1)
                    ends, pieces = [], []
                    scanned = [bool(x) for x, size in zip(row.scanned, sizes) for _ in range(size)]
                    kinds = set(scanned)
                    for scan in kinds:
                        own = word_text("\n".join(texts if len(kinds) == 1 else [t for t, x in zip(texts, scanned) if x == scan]))
                        # all words, less the first of every line
                        first_words = _LINE_FIRST.findall(own)
                        words[scan].update(_TOKEN.findall(own))
                        words[scan].subtract(first_words)
                        words[2 + scan].update(first_words)
                    for i, t in enumerate(texts):
                        tail = t[-1:] if t[-1:] not in _SPACES else t.rstrip()[-1:]
                        if not tail or tail not in HYPHENS or not (got := word_list(t)):
                            continue
                        # a fragment: the last word, which may be the first as well
                        words[scanned[i] + 2 * (len(got) == 1)][got[-1]] -= 1
                        if m := _PIECE.search(t.rstrip()):
                            ends.append(i)
                            pieces.append(m[1])
                    firsts = [w[1] if (w := _FIRST.search(t)) else "" for t in texts] if ends else []
                    docs.append(("doc", row.pdf_id, place, sizes, pages, bits, ends, pieces, firsts))
            yield _study_rows(pd.DataFrame(docs, columns=STUDY_COLUMNS[:9]))
            if sum(map(len, words)) > WORDS:
                yield counted()
        yield counted()
        # steps from and to open lines are not counted
        step = step[:6, :4]
        for kind, table in (("count", emit), ("step", step), ("head", chains[0]), ("tail", chains[1])):
            i, j = np.nonzero(table)
            yield _study_rows(pd.DataFrame({"kind": kind, "i": i, "j": j, "n": table[i, j]}))

    return stage(flats.mapInPandas(read, STUDY), "study")


def fitted(studied: DataFrame) -> tuple[LineModel, HeaderModel]:
    """The models with their parameters counted over all lines."""
    tables = {"count": np.zeros((5, 512)), "step": np.zeros((6, 4)), "head": np.zeros((CLASSES, CLASSES)), "tail": np.zeros((CLASSES, CLASSES))}
    # at most as many rows as these tables have cells, whatever the corpus
    for kind, i, j, n in studied.where("kind in ('count', 'step', 'head', 'tail')").groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect():
        tables[kind][i, j] = n
    return LineModel(tables["count"], tables["step"]), HeaderModel(tables["head"], tables["tail"])


def word_types(studied: DataFrame) -> DataFrame:
    """(word, clean, scan, clean_edge, scan_edge) over the corpus."""
    sums = [F.sum(c).alias(c) for c in ("clean", "scan", "clean_edge", "scan_edge")]
    return studied.where("kind = 'word'").groupBy("word").agg(*sums)


MARKS = "pdf_id bigint, place string, page_index int, page_no int, pos int, what string, piece string, next string, next_page int, next_index int, next_pos int"
MARK_COLUMNS = [c.split()[0] for c in MARKS.split(", ")]
_PLACES = {"page_index": "Int64", "page_no": "Int64", "pos": "Int64", "next_page": "Int64", "next_index": "Int64", "next_pos": "Int64"}


def line_marks(studied: DataFrame, model: LineModel) -> DataFrame:
    """Headers, page numbers and ends of lines at hyphens, with the word that begins the next line of text."""
    return studied.where("kind = 'doc'").select("pdf_id", "place", "sizes", "numbers", "bits", "ends", "pieces", "firsts").mapInPandas(_marks(model, False), MARKS)


def later_words(studied: DataFrame, model: LineModel, asked: DataFrame) -> DataFrame:
    """For the pieces ``asked`` (pdf_id, place, page_index, pos) the words that begin the other lines they may go on with."""
    own = asked.groupBy("pdf_id", "place").agg(F.collect_set(F.struct("page_index", "pos")).alias("asked"))
    docs = studied.where("kind = 'doc'").select("pdf_id", "place", "sizes", "numbers", "bits", "ends", "pieces", "firsts").join(own, ["pdf_id", "place"])
    return docs.mapInPandas(_marks(model, True), MARKS)


def _marks(model: LineModel, later: bool):
    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            if not len(frame):
                continue
            # one run of the model for all documents of the batch
            every = [np.asarray(b, dtype=np.int64) for b in frame["bits"]]
            marked = model.label(np.concatenate(every), np.concatenate([np.asarray(z, dtype=np.int64) for z in frame["sizes"]]))
            marked = np.split(marked, np.cumsum([len(b) for b in every])[:-1])
            for row, bits, labels in zip(frame.itertuples(index=False), every, marked):
                sizes, pages = np.asarray(row.sizes, dtype=int), row.numbers
                index = np.repeat(np.arange(len(sizes)), sizes)
                pos = np.arange(len(bits)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                page = lambda i: None if pages[index[i]] < 0 else int(pages[index[i]])  # noqa: B023,E731
                if not later:
                    for i in np.flatnonzero(labels <= NUMBER):
                        out.append((row.pdf_id, row.place, int(index[i]), page(i), int(pos[i]), "header" if labels[i] == HEADER else "page_number", None, None, None, None, None))
                wanted = {(a["page_index"], a["pos"]) for a in row.asked} if later else None
                for i, piece in zip(row.ends, row.pieces):
                    if labels[i] <= NUMBER or (later and (index[i], pos[i]) not in wanted):
                        continue
                    end = _next_page_end(index, i)
                    small, found = piece[-1:].islower(), 0
                    for k in range(i + 1, end):
                        word = row.firsts[k]
                        # the rest of a word in small letters begins with no capital
                        if labels[k] <= NUMBER or not word or (small and word[0].isupper()):
                            continue
                        found += 1
                        if not later or found > 1:
                            out.append((row.pdf_id, row.place, int(index[i]), page(i), int(pos[i]), "piece", piece, word, page(k), int(index[k]), int(pos[k])))
                        if not later:
                            break
                    if not found and not later:
                        out.append((row.pdf_id, row.place, int(index[i]), page(i), int(pos[i]), "piece", piece, "", page(i), int(index[i]), int(pos[i])))
            yield pd.DataFrame(out, columns=MARK_COLUMNS).astype(_PLACES)

    return mark


def _next_page_end(index: np.ndarray, i: int) -> int:
    """Where the next page that has lines ends."""
    end = int(np.searchsorted(index, index[i], side="right"))
    return int(np.searchsorted(index, index[end], side="right")) if end < len(index) else end


# ------------------------------------------------------------------ the notes
#: A stretch set with a space after every letter.
_SPACED = re.compile(r"(?:\S(?:\s+|$)){8,}")
_LABEL = re.compile(r"\[?\d{1,3}[\]).,:]?$|[*†‡§¶]")
#: Classes of words: the page's number; other figures; capitals; a capital first; the same before a colon, before another
#: mark; up to three small letters; more; before a mark; marks alone. Each before and after the page's number has come,
#: then the place before the first word and the one behind the last.
_KINDS = 10
FROM, TO, CLASSES = 2 * _KINDS, 2 * _KINDS + 1, 2 * _KINDS + 2


def word_class(word: str, page: int | None) -> int:
    bare = word.strip("[]().,:; ")
    if page is not None and (bare.translate(_DIGITS) == str(page)) and any(c.isdigit() or c in "lI" for c in bare):
        return 0
    letters = [c for c in bare if c.isalpha()]
    if not letters:
        return 1 if any(c.isdigit() for c in bare) else 9
    if any(c.isdigit() for c in bare) and len(letters) < 3:
        return 1
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return 2
    ends = word[-1] if word[-1] in ".,:;)?!]" else ""
    if letters[0].isupper():
        return 4 if ends == ":" else 5 if ends else 3
    return 8 if ends else 6 if len(letters) <= 3 else 7


def word_classes(words: list[str], page: int | None) -> list[int]:
    out, seen = [], 0
    for w in words:
        c = word_class(w, page)
        out.append(c + seen)
        if c == 0:
            seen = _KINDS
    return out


class HeaderModel:
    """Two Markov chains over classes of words: headers, and text that goes on from the page before."""

    def __init__(self, head: np.ndarray, tail: np.ndarray):
        part = lambda t: np.log((t + 0.1) / (t.sum(axis=1, keepdims=True) + 0.1 * CLASSES))
        # without a header there is nothing to tell
        self.head, self.tail = (part(head), part(tail)) if head.sum() else (None, None)
        # figures of the own page stand in text by chance, before and after alike
        self.text = None if self.head is None else part(tail + 0.5)

    def length(self, text: str, page: int | None) -> int:
        """Characters of ``text`` that are the running header of that page, or 0."""
        if self.head is None or page is None or not text:
            return 0
        places = [(m[0], m.end()) for m in re.finditer(r"\S+", text)]
        if m := _SPACED.match(text):
            # a stretch of letters is words, behind the last of which a header may end
            inner = unspaced(m[0].strip()).split()
            places = [(w, 0) for w in inner[:-1]] + [(inner[-1], m.end())] + [(w, e) for w, e in places if e > m.end()]
        path = [FROM, *word_classes([w for w, _ in places], page)]
        steps = self.head[path[:-1], path[1:]] - self.text[path[:-1], path[1:]]
        gain = np.cumsum(steps) + self.head[path[1:], TO]
        # behind the header text begins anew, with the words counted as if none had come
        plain = [c % _KINDS for c in path[1:]]
        after = np.append(self.text[FROM, plain[1:]] - self.text[path[1:-1], path[2:]], 0.0)
        gain = np.where([e > 0 for _, e in places], gain + after, -np.inf)
        # a number alone is no header
        gain[0] = -np.inf
        best = int(gain.argmax())
        return places[best][1] if gain[best] > 0 else 0


_TAIL = re.compile(r"(?:(?<=\s)|^)((?:[-–—·]\s*|\[|\()?(?:(?:Page|p\.|pg\.)\s*)?([0-9OIl]+(?:\s[0-9OIl])*|[ivxlcdm]+)(?:\s+of\s+[0-9OIl]+)?(?:\s*[-–—·]|\]|\))?\.?)$", re.I)


def number_at_end(text: str, page: int | None, model: LineModel) -> int:
    """Length of the page's own number at the end of ``text``, or 0; as a line of its own it has to be one to the model."""
    if page is None or not (m := _TAIL.search(text)):
        return 0
    return len(m[1]) if _is_number(re.sub(r"\s", "", m[2]), page) and model.prefers(NOTE | EDGE | SHORT | IS_NUMBER, NUMBER) else 0


def note_rows(sidecars: DataFrame) -> DataFrame:
    """(pdf_id, ordinal, page_start, source, pages, texts) of every note, once per PDF."""
    n = sidecars.select("pdf_id", F.explode("notes").alias("n"))
    n = n.select("pdf_id", F.col("n.ordinal").alias("ordinal"), F.col("n.page_start").alias("page_start"), F.col("n.text").alias("text"), F.coalesce("n.features.source", F.lit("text")).alias("source"), F.col("n.segments.page").alias("pages"), F.col("n.segments.text").alias("texts"))
    return n.dropDuplicates(["pdf_id", "ordinal", "page_start"])


def note_marks(notes: DataFrame, models: tuple[LineModel, HeaderModel]) -> DataFrame:
    """Headers, page numbers and broken words of notes; piece and its continuation stand in the text."""

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                kinds, plain = note_text(r.text, r.pages, r.texts, models)
                if pd.isna(r.ordinal) or pd.isna(r.page_start):
                    continue
                where = (r.pdf_id, "sidecar", 0, int(r.page_start), int(r.ordinal))
                out += [(*where, k, None, None, None, None, None) for k in sorted(kinds)]
                out += [(*where, "piece", m[1], m[2], int(r.page_start), 0, int(r.ordinal)) for m in _BROKEN.finditer(plain)]
            yield pd.DataFrame(out, columns=MARK_COLUMNS).astype(_PLACES)

    return notes.mapInPandas(mark, MARKS)


def note_text(text, pages, texts, models: tuple[LineModel, HeaderModel]) -> tuple[set[str], str]:
    """Kinds found in a note's text, and the text without its headers and page numbers."""
    texts = [t or "" for t in texts] if texts is not None and len(texts) else [text or ""]
    pages = [None if p is None or p != p else int(p) for p in pages] if pages is not None and len(pages) == len(texts) else [None] * len(texts)
    kinds, plain = set(), []
    for k, (t, page) in enumerate(zip(texts, pages)):
        t = t.strip()
        # between two parts of a note a page ends and another begins
        if k and (n := models[1].length(t, page)):
            kinds.add("header")
            t = t[n:].strip()
        if k < len(texts) - 1 and (n := number_at_end(t, page, models[0])):
            kinds.add("page_number")
            t = t[: len(t) - n].strip()
        plain.append(t)
    return kinds, " ".join(p for p in plain if p)


# ------------------------------------------------------------------ the words
def words_of(text: Column) -> Column:
    """Words of a text in lower case, without apostrophes and hyphens at their ends."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}†|]+(?:['’-]+[\p{L}\p{N}†|]+)*"), F.lit(0))


def page_lines(docs: DataFrame) -> DataFrame:
    """(pdf_id, place, page_index, page_no, pos, text, scanned) of every line."""
    pages = docs.select("pdf_id", F.posexplode("pages").alias("page_index", "p")).where("p is not null")
    none = F.array().cast("array<string>")
    side = lambda name: F.transform(F.coalesce(F.col(f"p.{name}_lines.text"), none), lambda t, i: F.struct(F.lit(name).alias("place"), i.alias("pos"), t.alias("text")))
    out = pages.select("pdf_id", "page_index", F.col("p.page_number").alias("page_no"), (F.coalesce("p.source", F.lit("text")) != "text").alias("scanned"), F.explode(F.concat(side("body"), side("note"))).alias("l"))
    return out.select("pdf_id", "l.place", "page_index", "page_no", "l.pos", "l.text", "scanned")


def misread_words(types: DataFrame) -> DataFrame:
    """(word, meant): words of scans that share the skeleton of a word of print and are none themselves."""
    t = types.withColumn("print", F.col("clean") + F.col("clean_edge")).withColumn("scans", F.col("scan") + F.col("scan_edge"))
    total = t.agg(F.greatest(F.sum("print"), F.lit(1)).alias("c"), F.greatest(F.sum("scans"), F.lit(1)).alias("s"))
    t = t.join(F.broadcast(total)).withColumn("n", F.col("clean") + F.col("scan"))
    rare = F.col("print") / F.col("c") < 0.2 * F.col("scans") / F.col("s")
    odd = t.where(rare & (F.length("word") >= 2) & F.col("word").rlike(r"[\p{L}†]")).select("word", F.col("scans").alias("n_odd"), skeleton(F.col("word")).alias("sk"))
    real = t.where(~rare & (F.col("n") >= 3) & F.col("word").rlike(r"^[a-z'’-]{2,}$|^[0-9]{1,3}(?:th|st|nd|rd)$"))
    # one word per skeleton, the most frequent, so that the join gives a row at most
    real = real.groupBy(skeleton(F.col("word")).alias("sk")).agg(F.max(F.struct("n", "word")).alias("r"))
    out = odd.join(real, "sk").where((F.col("r.word") != F.col("word")) & (F.col("r.n") >= 2 * F.col("n_odd")))
    return out.select("word", F.col("r.word").alias("meant"))


#: Verdicts on a piece before a hyphen and a word after it.
BROKEN, COMPOUND, LIKELY_COMPOUND, LIKELY_BROKEN, NONE = range(5)


def judge_pairs(pairs: DataFrame, types: DataFrame) -> DataFrame:
    """(piece, next, verdict, meant) of distinct pairs of a piece before a hyphen and a word after it.

    BROKEN: one word in two; COMPOUND: divided at its own hyphen; the likely
    ones where only the parts are known, or nothing is. ``meant`` is the whole
    word.
    """
    known = types.select("word", (F.col("clean") + F.col("scan")).alias("n"))
    low = lambda c: F.lower(F.regexp_replace(c, r"^.*[/:.]", ""))
    p, x = low(F.col("piece")), F.lower("next")
    roles = {"joined": F.concat(p, x), "compound": F.concat(p, F.lit("-"), x), "piece": p, "next": x}
    asked = F.array(*[F.struct(F.lit(role).alias("role"), word.alias("word")) for role, word in roles.items()])
    q = pairs.select("piece", "next", F.explode(asked).alias("a")).select("piece", "next", "a.role", "a.word")
    counts = [F.max(F.when(F.col("role") == r, F.col("n"))).alias(f"n_{r}") for r in roles]
    got = q.join(known, "word", "left").groupBy("piece", "next").agg(*counts).fillna(0)
    got = stage(got, "judged-pairs")
    # only what is no word as it stands is looked up by its image
    images = known.where((F.col("n") >= 3) & F.col("word").rlike(r"^[a-z'’-]{4,}$")).groupBy(skeleton(F.col("word")).alias("sk")).agg(F.max(F.struct("n", "word")).alias("r"))
    unknown = got.where("n_joined = 0 and n_compound = 0 and next <> ''").select("piece", "next", F.explode(F.array(F.struct(F.lit("joined").alias("role"), roles["joined"].alias("word")), F.struct(F.lit("compound").alias("role"), roles["compound"].alias("word")))).alias("a"))
    image = unknown.select("piece", "next", "a.role", skeleton(F.col("a.word")).alias("sk")).join(images, "sk")
    image = image.groupBy("piece", "next").agg(F.max(F.when(F.col("role") == "joined", F.col("r.word"))).alias("by_image"), F.max(F.when(F.col("role") == "compound", F.col("r.word"))).alias("compound_image"))
    got = got.join(image, ["piece", "next"], "left")
    verdict = (
        F.when((F.col("n_joined") > 0) & (F.col("n_joined") >= F.col("n_compound")) & (F.col("next") != ""), BROKEN)
        .when(F.col("n_compound") > 0, COMPOUND)
        .when(F.col("by_image").isNotNull(), BROKEN)
        .when(F.col("compound_image").isNotNull() | F.col("piece").rlike(r"://|^www\."), COMPOUND)
        .when((F.col("next") == "") & (F.col("n_piece") == 0), BROKEN)
        .when((F.col("n_piece") > 1) & (F.col("n_next") > 1) | (F.col("next") == ""), LIKELY_COMPOUND)
        .when(F.col("next").rlike(r"^\p{Ll}"), LIKELY_BROKEN)
        .otherwise(NONE)
    )
    return got.select("piece", "next", verdict.alias("verdict"), F.when(verdict == BROKEN, F.when(F.col("n_joined") > 0, roles["joined"]).otherwise(F.col("by_image"))).alias("meant"))


def judged(marks: DataFrame, types: DataFrame, studied: DataFrame, model: LineModel) -> DataFrame:
    """The pieces of ``marks`` that are broken words, with the words that continue them.

    The next line of text decides where its word completes the piece or its
    compound; only for the other pieces all lines up to the end of the next page
    are asked, the nearest that does so decides, and if there is none, the first
    line.
    """
    ref = ["pdf_id", "place", "page_index", "page_no", "pos"]
    told = [*ref, "piece", "next", "next_page", "next_index", "next_pos"]
    judge = lambda each: each.join(judge_pairs(each.select("piece", "next").distinct(), types), ["piece", "next"])
    first = stage(judge(marks.where("what = 'piece'").select(*told)), "pieces")
    sure = F.col("verdict") <= COMPOUND
    left = first.where(~sure & (F.col("place") != "sidecar") & (F.col("next") != ""))
    later = stage(later_words(studied, model, left.select("pdf_id", "place", "page_index", "pos")).select(*told), "later")
    order = F.struct("next_index", "next_pos", "verdict", "next", "next_page", "meant")
    at = ["pdf_id", "place", "page_index", "pos"]
    later = stage(judge(later).where(sure).groupBy(*at).agg(F.min(order).alias("b")).select(*at, "b.*"), "completed")
    alone = first.where(F.col("verdict").isin(BROKEN, LIKELY_BROKEN)).join(later.select(*at), at, "left_anti")
    done = later.where(F.col("verdict") == BROKEN).join(left.select(*ref, "piece").distinct(), at)
    out = [*ref, "piece", "next", "next_page", "next_index", "next_pos", "meant"]
    return alone.select(*out).unionAll(done.select(*out))


def find(docs: DataFrame, sidecars: DataFrame) -> dict[str, DataFrame]:
    """All marks of both tables: ``lines`` and ``notes`` (marks), ``broken``, ``misread`` (with the word meant)."""
    docs = docs.select("pdf_id", "pages")
    studied = study(flat(docs))
    models = fitted(studied)
    notes = note_rows(sidecars.select("pdf_id", "notes"))
    marks = stage(line_marks(studied, models[0]).unionAll(note_marks(notes, models)), "marks")
    lines = page_lines(docs)
    types = stage(word_types(studied), "types")
    wrong = stage(misread_words(types), "misread")
    broken = stage(judged(marks, types, studied, models[0]), "broken")
    small = broadcast_if_small(wrong)
    ref = ["pdf_id", "place", "page_index", "page_no", "pos"]
    scans = lines.where("scanned and text is not null").select(*ref, F.explode(words_of(F.col("text"))).alias("word"))
    noted = notes.where("source <> 'text' and text is not null").select("pdf_id", F.lit("sidecar").alias("place"), F.lit(0).alias("page_index"), F.col("page_start").alias("page_no"), F.col("ordinal").alias("pos"), F.explode(words_of(F.col("text"))).alias("word"))
    # staged, or the anti-join below would be pushed under this join, onto every word of the scans
    misread = stage(scans.unionAll(noted).join(small, "word").select(*ref, "word", "meant"), "found")
    # the halves of broken words are fragments, judged below with the whole word
    after = broken.select("pdf_id", "place", F.col("next_index").alias("page_index"), F.col("next_page").alias("page_no"), F.col("next_pos").alias("pos"), F.lower("next").alias("word"))
    halves = marks.where("what = 'piece'").select(*ref, F.lower("piece").alias("word")).unionAll(after)
    misread = misread.join(halves, ref + ["word"], "left_anti")
    # a broken word whose halves are not those of the word meant
    halves = broken.where("meant is not null")
    a = halves.where(~F.expr("startswith(meant, lower(regexp_replace(piece, '^.*[/:.]', '')))")).select(*ref, F.lower("piece").alias("word"), "meant")
    b = halves.where(~F.expr("endswith(meant, lower(next))")).select("pdf_id", "place", F.col("next_index").alias("page_index"), F.col("next_page").alias("page_no"), F.col("next_pos").alias("pos"), F.lower("next").alias("word"), "meant")
    return {"marks": marks, "broken": broken, "misread": misread.unionAll(a).unionAll(b), "models": models, "wrong": wrong}


# --------------------------------------------------------------- the repaired text
_MARK = re.compile(r"^\[?[0-9]{1,4}[\]).]?\s+\S")
_WORD = re.compile(r"[\w†|]+(?:['’-][\w†|]+)*")
TEXTS = "pdf_id bigint, place string, paragraph int, first_page int, last_page int, text string"


def corrected(text: str, meant: dict[str, str]) -> str:
    """Misread words by the words meant, in the case of the first letter."""
    if not meant:
        return text

    def right(m: re.Match) -> str:
        word = meant.get(m[0].lower())
        return m[0] if word is None else word.upper() if m[0].isupper() and len(m[0]) > 1 else word.capitalize() if m[0][0].isupper() else word

    return _WORD.sub(right, text)


def paragraphs(texts, pages, labels, joins: set[int], note: bool) -> Iterator[tuple[int, int, str]]:
    """(first page, last page, text) of the paragraphs of one document's body or notes."""
    text, first, last, open_at = "", None, None, None
    for i, t in enumerate(texts):
        t = re.sub(r"\s+", " ", t or "").strip()
        if labels[i] <= NUMBER or not t:
            continue
        if text and note and _MARK.match(t) and open_at is None:
            yield first, last, text
            text = ""
        if not text:
            text, first = t, pages[i]
        elif open_at == "word":
            text = text[:-1] + t
        elif open_at == "hyphen":
            text += t
        else:
            text += " " + t
        last = pages[i]
        open_at = "word" if i in joins else "hyphen" if t[-1] in HYPHENS and len(t) > 1 and t[-2].isalpha() else None
        if labels[i] == BREAK and open_at is None:
            yield first, last, text
            text = ""
    if text:
        yield first, last, text


def repaired_lines(docs: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Paragraphs of body and notes: headers and page numbers left out, broken words joined, misread words corrected."""
    flats, model = flat(docs.select("pdf_id", "pages")), parts["models"][0]
    joins = parts["broken"].where("place <> 'sidecar'").groupBy("pdf_id").agg(F.collect_list(F.struct("place", "page_index", "pos")).alias("joins"))
    # the words of one document that are misread
    fixes = parts["misread"].where("place <> 'sidecar'").groupBy("pdf_id").agg(F.collect_set(F.struct("word", "meant")).alias("fixes"))
    rows = flats.join(joins, "pdf_id", "left").join(fixes, "pdf_id", "left")

    def repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                meant = {f["word"]: f["meant"] for f in row.fixes} if row.fixes is not None else {}
                where = {(j["place"], j["page_index"], j["pos"]) for j in row.joins} if row.joins is not None else set()
                for place, texts, sizes, pages, bits in _sides(row):
                    labels, index = model.label(bits, sizes), np.repeat(np.arange(len(sizes)), sizes)
                    pos = np.arange(len(texts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    own = {i for i in range(len(texts)) if (place, index[i], pos[i]) in where}
                    for n, (a, b, text) in enumerate(paragraphs(texts, [pages[k] for k in index], labels, own, place == "note")):
                        out.append((row.pdf_id, place, n, a, b, corrected(text, meant)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in TEXTS.split(", ")])

    return rows.mapInPandas(repair, TEXTS)


def repaired_notes(sidecars: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Notes of sidecars, once per PDF, as continuous text."""
    ref = ["pdf_id", "page_no", "pos"]
    joins = parts["broken"].where("place = 'sidecar'").groupBy(*ref).agg(F.collect_set(F.struct("piece", "next")).alias("joins"))
    fixes = parts["misread"].where("place = 'sidecar'").groupBy(*ref).agg(F.collect_set(F.struct("word", "meant")).alias("fixes"))
    notes = note_rows(sidecars.select("pdf_id", "notes")).withColumnRenamed("page_start", "page_no").withColumnRenamed("ordinal", "pos")
    rows, models = notes.join(joins, ref, "left").join(fixes, ref, "left"), parts["models"]

    def repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                plain = note_text(r.text, r.pages, r.texts, models)[1]
                pairs = {(j["piece"], j["next"]) for j in r.joins} if r.joins is not None else set()
                plain = _BROKEN.sub(lambda m: m[1] + ("" if (m[1], m[2]) in pairs else "-") + m[2], plain)  # noqa: B023
                meant = {f["word"]: f["meant"] for f in r.fixes} if r.fixes is not None else {}
                page = None if pd.isna(r.page_no) else int(r.page_no)
                out.append((r.pdf_id, "sidecar", None if pd.isna(r.pos) else int(r.pos), page, page, corrected(re.sub(r"\s+", " ", plain), meant)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in TEXTS.split(", ")])

    return rows.mapInPandas(repair, TEXTS)


def found(parts: dict[str, DataFrame]) -> DataFrame:
    """(pdf_id, place, page_no, pos, kind), each once."""
    ref = ["pdf_id", "place", "page_no", "pos"]
    out = parts["marks"].where("what <> 'piece'").select(*ref, F.col("what").alias("kind"))
    out = out.unionAll(parts["broken"].select(*ref, F.lit("hyphen").alias("kind"))).unionAll(parts["misread"].select(*ref, F.lit("misread").alias("kind")))
    return out.distinct()
