"""Text functions as Column expressions.

Patterns use ASCII classes, so that they mean the same in other engines. NULL
text counts as empty.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Patterns of legal citations, addresses and years.
NAME = r"[A-Z][A-Za-z0-9_'’.-]+"
CASE = rf"\b{NAME}(?:\s+{NAME})*\s+v\.\s+{NAME}"
STATUTE = r"\b\d+\s+U\.?S\.?C\.?\s*§+\s*[A-Za-z0-9_.-]+"
REGULATION = r"\b\d+\s+C\.?F\.?R\.?\s*§+\s*[A-Za-z0-9_.-]+"
MUNICIPAL = r"\b(?:municipal\s+code|mun\.\s+code|city\s+code|county\s+code|code\s+of\s+ordinances)\s*§+\s*[A-Za-z0-9_.-]+"
HISTORY = r"\b(?:H\.R\.|S\.)\s*(?:Rep\.|Doc\.|Conf\.\s*Rep\.)\s*No\.?\s*[A-Za-z0-9_-]+"
TREATY = r"\b(?:treaty|convention|protocol)\b"
SECONDARY = r"\b\d+\s+[A-Z][A-Za-z.\s&,'-]+\s+L\.\s*Rev\.\s+\d+\b"
CITATIONS = {
    "case": CASE, "statute": STATUTE, "regulation": REGULATION, "municipal_code": MUNICIPAL, "legislative_history": HISTORY,
    "treaty_or_international": TREATY, "secondary_source": SECONDARY,
}
URL = r"https?://[^\s)\]>\"']+"
EMAIL = r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
YEAR = r"\b(?:19|20)\d{2}\b"
SHORT_CITE = r"\b(?:id\.|ibid\.|supra|infra)"
HEADING = r"^(?:(?:part|chapter|section)\s+[0-9ivxlc]+\b|[ivxlc]+\.\s|(?:abstract|introduction|conclusion|background)\b)"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0b]+", " "))


def first_of_each(values: Column, key) -> Column:
    """Values whose key did not occur before, in order."""
    kept = F.aggregate(
        values,
        F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("out")),
        lambda acc, v: F.when(F.array_contains(acc["keys"], key(v)), acc).otherwise(F.struct(F.array_append(acc["keys"], key(v)).alias("keys"), F.array_append(acc["out"], v).alias("out"))),
    )
    return kept["out"]


def citation_type(text: Column) -> Column:
    """The first kind of citation that occurs, else ``other``."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(CITATIONS.items()):
        out = F.when(F.coalesce(text, F.lit("")).rlike("(?i)" + pattern), F.lit(kind)).otherwise(out)
    return F.coalesce(out, F.lit("other"))


def citation_mentions(text: Column) -> Column:
    """array<struct<kind, text>>: matches of every kind, each spelling once whatever its case, in order."""

    def mentions(kind: str, pattern: str) -> Column:
        values = first_of_each(F.transform(_all(text, "(?i)" + pattern), collapse), F.lower)
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("text")))

    return F.concat(*[mentions(kind, pattern) for kind, pattern in CITATIONS.items()])


def urls(text: Column) -> Column:
    """Addresses without closing punctuation, each once, in order."""
    return F.filter(F.array_distinct(F.transform(_all(text, "(?i)" + URL), lambda u: F.rtrim(u, F.lit(".,;:)")))), lambda u: u.rlike("(?i)^https?://."))


def emails(text: Column) -> Column:
    return first_of_each(_all(text, "(?i)" + EMAIL), F.lower)


def years(text: Column) -> Column:
    return F.array_sort(F.array_distinct(_all(text, YEAR)))


def citations(text: Column) -> Column:
    """Statutes, cases and law reviews, distinct."""
    return F.array_distinct(F.transform(F.concat(_all(text, STATUTE), _all(text, CASE), _all(text, SECONDARY)), collapse))


def unified(text: Column) -> Column:
    """Plain dashes and quotes, lower case, single spaces."""
    return collapse(F.lower(F.translate(text, "‐‑‒–—―‘’‛“”„ ", "------'''\"\"\" ")))


def note_text(text: Column) -> Column:
    """Unified text without soft hyphens and back links, words broken at hyphens joined."""
    plain = F.regexp_replace(F.regexp_replace(text, "[­↩︎]", ""), r"([A-Za-z])-\s+([a-z])", "$1$2")
    return unified(plain)


def joined_hyphens(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=[A-Za-z])- (?=[a-z])", "")


def tokens(text: Column) -> Column:
    return _all(text, r"[A-Za-z0-9_]+(?:['.-][A-Za-z0-9_]+)*|[^A-Za-z0-9_\s]")


def sentences(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")


def section_headers(text: Column) -> Column:
    """Lines of at most 120 characters and 16 words that are capitals or headings, distinct."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))
    words = lambda s: F.size(F.split(s, r"\s+"))
    head = lambda s: (F.length(s) > 0) & (F.length(s) <= 120) & (words(s) <= 16) & ((s.rlike("[A-Z]") & (s == F.upper(s))) | F.lower(s).rlike(HEADING))
    return F.array_distinct(F.filter(lines, head))


def word_key(text: Column) -> Column:
    """Lower case, everything but letters and digits as single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def first_text_hash(text: Column, size: int = 500) -> Column:
    key = word_key(text)
    return F.when(key != "", F.sha2(F.substring(key, 1, size), 256))


@F.pandas_udf(StringType())
def compatible_key(values: pd.Series) -> pd.Series:
    """NFKC, case folded, punctuation as spaces: what no built-in expression does."""

    def one(v):
        if v is None:
            return None
        folded = unicodedata.normalize("NFKC", v).casefold()
        return " ".join("".join(c if c.isalnum() else " " for c in folded).split())

    return values.map(one)


@F.pandas_udf(StringType())
def plain_name(values: pd.Series) -> pd.Series:
    """Journal names without marks, case, punctuation and a leading article; ``&`` is ``and``."""

    def one(v):
        if v is None:
            return None
        text = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).casefold().replace("&", " and ")
        words = "".join(c if c.isalnum() else " " for c in text).split()
        return " ".join(words[1:] if words[:1] == ["the"] else words)

    return values.map(one)


def split_names(text: Column) -> Column:
    """Authors of a line, split at semicolons, commas and the word ``and``."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\s+and\s+|[;,]"), lambda x: F.trim(x)), lambda n: n != "")


def first_number(text: Column) -> Column:
    """The first digits of a text as a number, at most nine."""
    return F.regexp_extract(F.coalesce(text.cast("string"), F.lit("")), "([0-9]{1,9})", 1).try_cast("int")
