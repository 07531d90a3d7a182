"""Encoding of a corpus with a public byte-level tokenizer.

Texts are cut into content-defined chunks by a rolling hash. Chunks that occur
more than once in the corpus are encoded once, by the document that holds their
first occurrence, and travel as ids to the others; everything else is encoded
in place, so that only hashes of chunks are shuffled beside the texts. Chunk
joins are repaired: of a chunk only its core, from its first to its last *agreed*
position, is taken over, and the stretch between two cores is encoded again with
its neighbours. A position is agreed where white space follows a printable
ASCII character: no token of the tokenizer's pattern crosses it and the pattern
looks at nothing before it, so the ids on both sides are those of the whole text.

Defined results: a NULL or empty text has the empty list; a row given twice
gives two rows; rows of NULL id are encoded like others; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Mean length of a chunk in code points is 2 ** CHUNK_BITS.
CHUNK_BITS = 8
WINDOW = 32
#: Words whose ids a Python worker remembers.
WORDS = 300_000

# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WORD = re.compile(r"[ \n\t]*[^ \n\t]+|[ \n\t]+")
_ODD_SPACE = re.compile(r"[^\S \n\t]")


class Encoder:
    """ids of texts; remembers the ids of words between two agreed positions."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, list[int]] = {}

    def ids(self, text: str) -> list[int]:
        if not text:
            return []
        if _ODD_SPACE.search(text):
            return self.encode(text)
        known, out = self.known, []
        for word in _WORD.findall(text):
            got = known.get(word)
            if got is None:
                got = self.encode(word)
                if len(word) <= 40:
                    if len(known) >= WORDS:
                        known.clear()
                    known[word] = got
            out += got
        return out

    def count(self, text: str) -> int:
        return len(self.ids(text)) if text else 0


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """Number of tokens of a text; 0 for NULL and empty ones."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        size = encoder(path).count
        return pd.Series([size(t) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    return count(text)


def _gear() -> np.ndarray:
    """Pseudo-random numbers for code points modulo 4096."""
    x = np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def cut_points(text: str, bits: int = CHUNK_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(cuts, agreed positions) of a text, in code points.

    A cut lies where the rolling hash of the WINDOW code points before it ends
    in ``bits`` zeros, so equal stretches of text are cut alike wherever they
    stand.
    """
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    h = _GEAR[cp & 4095]
    step = 1
    while step < WINDOW:
        moved = np.zeros_like(h)
        moved[step:] = h[:-step]
        h = h + (moved << np.uint32(step))
        step *= 2
    top = np.uint32(((1 << bits) - 1) << (32 - bits))
    cuts = np.flatnonzero((h & top) == 0) + 1
    cuts = cuts[(cuts >= WINDOW) & (cuts < len(cp))]
    space = (cp == 32) | (cp == 10) | (cp == 9)
    printed = (cp > 32) & (cp < 127)
    agreed = np.flatnonzero(space[1:] & printed[:-1]) + 1
    return cuts, agreed


_GEAR = _gear()


def chunks(text: str, bits: int = CHUNK_BITS) -> list[tuple[int, int, int, int]]:
    """(start, end, core start, core end) of chunks with a core; the rest has none."""
    if len(text) < 2 * WINDOW:
        return []
    cuts, agreed = cut_points(text, bits)
    if not len(agreed):
        return []
    edges = np.concatenate(([0], cuts, [len(text)]))
    first = np.searchsorted(agreed, edges[:-1], side="right")  # strictly inside the chunk
    last = np.searchsorted(agreed, edges[1:], side="left") - 1
    out = []
    for i in np.flatnonzero(last > first):
        out.append((int(edges[i]), int(edges[i + 1]), int(agreed[first[i]]), int(agreed[last[i]])))
    return out


def _hash(text: str) -> tuple[int, int]:
    import xxhash

    h = xxhash.xxh3_128_intdigest(text.encode("utf-8", "surrogatepass"))
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def chunk_table(documents: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(doc_id, tk, k, h1, h2): the chunks of every text, without their text."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, tk, text in zip(frame["doc_id"], frame["tk"], frame["text"]):
                for k, (a, b, _, _) in enumerate(chunks(text, bits)):
                    rows.append((doc_id, tk, k, *_hash(text[a:b])))
            yield pd.DataFrame(rows, columns=["doc_id", "tk", "k", "h1", "h2"])

    filled = documents.where(F.length("text") >= 2 * WINDOW)
    return filled.mapInPandas(cut, "doc_id bigint, tk bigint, k int, h1 bigint, h2 bigint")


def encode_corpus(documents: DataFrame, path: str = TOKENIZER, bits: int = CHUNK_BITS) -> DataFrame:
    """(doc_id, ids) of every row of documents (doc_id, text)."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tk"))
    cut = stage(chunk_table(docs.where("doc_id is not null"), bits), "chunks")
    owner = F.min(F.struct("doc_id", "tk", "k"))
    shared = cut.groupBy("h1", "h2").agg(F.count("*").alias("n"), owner.alias("o")).where("n > 1")
    marks = cut.join(shared, ["h1", "h2"]).select("doc_id", "tk", F.struct("k", "h1", "h2", (F.struct("doc_id", "tk", "k") == F.col("o")).alias("own")).alias("m"))
    marks = marks.groupBy("doc_id", "tk").agg(F.collect_set("m").alias("marks"))
    marked = docs.join(marks.hint("shuffle_hash"), ["doc_id", "tk"], "left").select("doc_id", "tk", "text", "marks")

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(path).ids
        # rows of the same id and text are told apart by their task and their number in it
        task, seen = TaskContext.get().partitionId() << 40, Counter()
        for frame in frames:
            whole, parts, copy = [], [], []
            for doc_id, tk, text, mark in zip(frame["doc_id"], frame["tk"], frame["text"], frame["marks"]):
                lent = {m["k"]: (m["h1"], m["h2"]) for m in mark if not m["own"]} if mark is not None else None
                if not lent:
                    whole.append(ids(text) if isinstance(text, str) else [])
                    parts.append(None)
                    copy.append(0)
                    continue
                cut, out, at = chunks(text, bits), [], 0
                for k in sorted(lent):
                    _, _, a, b = cut[k]
                    out.append({"h1": None, "h2": None, "ids": ids(text[at:a])})
                    out.append({"h1": lent[k][0], "h2": lent[k][1], "ids": None})
                    at = b
                out.append({"h1": None, "h2": None, "ids": ids(text[at:])})
                whole.append(None)
                parts.append(out)
                copy.append(task + seen[(doc_id, tk)])
                seen[(doc_id, tk)] += 1
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "tk": frame["tk"], "copy": copy, "ids": whole, "parts": parts})

    def lend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(path).ids
        for frame in frames:
            rows = []
            for text, mark in zip(frame["text"], frame["marks"]):
                cut = chunks(text, bits)
                for m in mark:
                    if m["own"]:
                        _, _, a, b = cut[m["k"]]
                        rows.append((m["h1"], m["h2"], ids(text[a:b])))
            yield pd.DataFrame(rows, columns=["h1", "h2", "core"])

    owners = marked.where(F.exists("marks", lambda m: m["own"]))
    cores = owners.mapInPandas(lend, "h1 bigint, h2 bigint, core array<int>").dropDuplicates(["h1", "h2"])
    done = marked.mapInPandas(encode, "doc_id bigint, tk bigint, copy bigint, ids array<int>, parts array<struct<h1: bigint, h2: bigint, ids: array<int>>>")
    done = stage(done, "encoded")
    open_parts = done.where("parts is not null").select("doc_id", "tk", "copy", F.posexplode("parts").alias("pos", "part"))
    open_parts = open_parts.select("doc_id", "tk", "copy", "pos", F.col("part.h1").alias("h1"), F.col("part.h2").alias("h2"), F.col("part.ids").alias("ids"))
    joined = open_parts.where("h1 is not null").join(cores, ["h1", "h2"]).select("doc_id", "tk", "copy", "pos", F.col("core").alias("ids"))
    joined = joined.unionAll(open_parts.where("h1 is null").select("doc_id", "tk", "copy", "pos", "ids"))
    repaired = joined.groupBy("doc_id", "tk", "copy").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("p")).select("doc_id", F.flatten(F.col("p.ids")).alias("ids"))
    return done.where("parts is null").select("doc_id", "ids").unionAll(repaired)
