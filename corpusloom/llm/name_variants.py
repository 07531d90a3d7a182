"""Variant spellings of the names of people, institutions and journals.

Whole names, each in one order of its words, are joined within one edit by
metric-space partitioning. Where two joined names differ in one word and one of
the two words is a typing error by what is attested for both, the better one
takes its place in all names. Over corrected words a name has a structured key
(surname, given name through nicknames, middle initial; or the kind, place and
subjects of an institution), and variants meet in equi-joins on these keys.
Initials and missing middle names are resolved where exactly one person fits,
by least and greatest fitting persons, so that no surname is joined with itself.
Journals are aligned word by word, with abbreviations, to the registry's names,
a table of fixed size.

Defined results: NULL and blank names are none; names are trimmed; a spelling
counts once however often it is typed; a name that fits several persons is
linked to none; empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.metric_join import radius_join, within_one
from corpusloom.session import stage

# Titles, kinds of institutions with their abbreviations, abbreviations
# of journals' words, and nicknames of given names.
TITLES = {"prof", "professor", "dr", "mr", "mrs", "ms", "hon", "judge", "justice", "rev", "sir"}
KINDS = {
    "institute": ("inst", "inst'"), "center": ("ctr", "cent", "centre"), "association": ("ass'n", "assn", "assoc"),
    "committee": ("comm", "cmte", "committe"), "commission": ("comm'n", "commn"), "council": (), "society": ("soc'y", "socy", "soc"), "university": ("univ", "u"),
    "school": ("sch",), "college": ("coll",), "department": ("dep't", "dept"), "board": ("bd",), "foundation": ("found",), "federation": ("fed'n",),
    "academy": ("acad",), "bureau": (), "office": ("off",), "project": ("proj",), "program": ("prog",), "clinic": (), "network": (), "court": ("ct",), "library": ("libr",),
}
SMALL = {"for", "of", "and", "the", "at", "in", "on", "a", "an", "law", "l", "&", "to"}
JOURNAL_WORDS = {
    "j": "journal", "jnl": "journal", "jour": "journal", "l": "law", "rev": "review", "q": "quarterly", "qtly": "quarterly", "int'l": "international", "intl": "international",
    "pol'y": "policy", "poly": "policy", "stud": "studies", "u": "university", "univ": "university", "bull": "bulletin", "ann": "annual", "am": "american",
}
NICKNAMES = {
    "abigail": "abby gail", "alexander": "alex sandy", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben benny",
    "catherine": "cathy kate cat", "katherine": "kathy kate katie kat", "charles": "charlie chuck", "christopher": "chris kit topher", "daniel": "dan danny",
    "david": "dave", "deborah": "deb debbie", "donald": "don", "dorothy": "dot dottie dolly", "edward": "ed eddie ted ned teddy", "elizabeth": "liz beth betty eliza lizzie",
    "frederick": "fred freddie fritz", "gabriela": "gaby gabi", "gregory": "greg", "hannelore": "hanne lore", "henry": "harry hank", "isabella": "bella izzy", "jacob": "jake",
    "james": "jim jimmy jamie", "jennifer": "jen jenny", "jonathan": "jon", "john": "jack johnny", "joseph": "joe", "kenneth": "ken", "lawrence": "larry", "leonard": "len lenny leo",
    "margaret": "meg peggy maggie marge", "matthew": "matt", "michael": "mike mick", "nicholas": "nick nico", "olivia": "liv livvy", "patricia": "trish pat patty tricia", "patrick": "pat paddy",
    "peter": "pete", "philip": "phil", "quentin": "quin quinn", "rebecca": "becky", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "ronald": "ron", "samuel": "sam",
    "stephen": "steve", "susan": "sue suzy", "susannah": "sue susie sanna", "theodore": "theo ted teddy", "thomas": "tom tommy", "timothy": "tim", "ulrike": "uli ulli rike",
    "victoria": "vicky vicki tori", "walter": "walt", "william": "bill will billy willy liam", "yolanda": "yoli yola", "zachary": "zack zach zak",
}
_KIND = {a: k for k, short in KINDS.items() for a in (k, *short)}


def name_tokens(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+(?:['’][^\W\d_]+)*", text.lower().replace("’", "'"))


def spellings(column: DataFrame) -> DataFrame:
    """(name, n): distinct trimmed spellings of a column ``name``."""
    trimmed = F.trim("name")
    return column.select(trimmed.alias("name")).where(trimmed != "").groupBy("name").agg(F.count("*").alias("n"))


def author_names(holdings: DataFrame) -> DataFrame:
    return spellings(holdings.select(F.explode(F.split("authors", ";")).alias("name")))


def token_table(names: DataFrame) -> DataFrame:
    """(token, spellings, n): in how many spellings and rows each word of two or more letters stands."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.replace("name", F.lit("’"), F.lit("'"))), F.lit(r"[\p{L}]+(?:'[\p{L}]+)*"), F.lit(0)))
    each = names.select("n", F.explode(words).alias("token")).where(F.length("token") >= 2)
    return each.groupBy("token").agg(F.count("*").alias("spellings"), F.sum("n").alias("n"))


def name_forms(name: str) -> set[str]:
    """The strings by which a whole name of a person or institution is compared.

    A person is surname and given name, and surname and initial, since others
    may have typed no more; an institution is its words in order of their
    letters and, since an error may change that, of their letters read
    backwards. Names of several long words may be either.
    """
    tokens, out = name_tokens(name), set()
    kind, surname, given = _parts(name)
    if kind == "person":
        out = {f"{surname} {g}" for g in (given, given[:1]) if g} or {surname}
    if kind == "institution" or len([t for t in tokens if len(t) >= 3 and t not in TITLES and t not in SMALL]) >= 4:
        out |= _orders([w for w in tokens if w not in SMALL])
    return out - {""}


def _orders(words: list[str]) -> set[str]:
    return {" ".join(sorted(words)), " ".join(sorted(words, key=lambda w: w[::-1]))}


#: Words between the words of a journal's name.
BETWEEN = frozenset({"and", "the", "of", "at", "for", "in", "on"})


def journal_words(name: str) -> list[str]:
    return [t for t in name_tokens(name.replace("&", " and ")) if t not in BETWEEN]


def written_out(word: str, vocabulary: frozenset[str]) -> str:
    """A word of a journal's name in full: by the table of abbreviations, or as the only known word it begins."""
    if word in vocabulary:
        return word
    if word in JOURNAL_WORDS:
        return JOURNAL_WORDS[word]
    longer = [w for w in vocabulary if len(word) >= 3 and w.startswith(word)]
    return longer[0] if len(longer) == 1 else word


def shortened(word: str) -> set[str]:
    """Abbreviations of a word of three letters or more: those of the table, and beginnings that leave three letters out."""
    return {k for k, v in JOURNAL_WORDS.items() if v == word and len(k) >= 3} | {word[:n] for n in (3, 4, 5, 6) if n <= len(word) - 3}


def journal_forms(name: str, vocabulary: frozenset[str], listed: bool) -> set[str]:
    """The strings by which a journal's name is compared: its words in full, and for a listed name also with one of them abbreviated, since the error may be in an abbreviation."""
    words = journal_words(name)
    out = _orders([written_out(w, vocabulary) for w in words])
    if listed:
        for i, w in enumerate(words):
            for short in shortened(w):
                out |= _orders([*words[:i], short, *words[i + 1 :]])
    return out - {""}


def whole_names(names: DataFrame) -> DataFrame:
    """(word): the forms of all names of persons and institutions."""

    @F.pandas_udf("array<string>")
    def forms(name: pd.Series) -> pd.Series:
        return name.map(lambda n: sorted(name_forms(n)))

    return names.select(F.explode(forms("name")).alias("word")).distinct()


def whole_journals(names: DataFrame, listed: DataFrame, vocabulary: frozenset[str]) -> DataFrame:
    """(word): the forms of typed and of listed journals."""

    @F.pandas_udf("array<string>")
    def forms(name: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([sorted(journal_forms(n, vocabulary, k)) for n, k in zip(name, known)], dtype=object)

    both = names.select("name", F.lit(False).alias("known")).unionAll(listed.select("name", F.lit(True).alias("known")))
    return both.select(F.explode(forms("name", "known")).alias("word")).distinct()


def differing_words(pairs: DataFrame) -> DataFrame:
    """(x, y), both ways: the words in which two joined names differ, where it is one each and no initial."""
    a, b = F.split("a", " "), F.split("b", " ")
    d = pairs.select(F.array_except(a, b).alias("x"), F.array_except(b, a).alias("y")).where("size(x) = 1 and size(y) = 1").select(F.get("x", F.lit(0)).alias("x"), F.get("y", F.lit(0)).alias("y"))
    # both ways from one row, so that the join runs once
    both = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    return d.where("length(x) >= 2 and length(y) >= 2").select(F.inline(both)).distinct()


def corrections(tokens: DataFrame, pairs: DataFrame) -> DataFrame:
    """(token, right): words that are typing errors of a word in more spellings.

    ``pairs`` (x, y) are words in which joined names differ. The right word must
    be attested by more spellings, and so much more that two real names one edit
    apart stay two. Known given names, nicknames and kinds of institutions are
    never errors, and win over an unknown word of as many spellings.
    """
    sure = sorted({*NICKNAMES, *_NICK, *_KIND, *(g[:3] for g in NICKNAMES)})
    t = tokens.select(F.col("token").alias("x"), F.col("spellings").alias("sx"), F.col("n").alias("nx"))
    j = pairs.join(t, "x").join(t.select(F.col("x").alias("y"), F.col("sx").alias("sy"), F.col("nx").alias("ny")), "y")
    better = ((F.col("sy") > F.col("sx")) & ((F.col("sx") <= 1) | (F.col("sx") * 4 <= F.col("sy")))) | ((F.col("sy") == F.col("sx")) & F.col("y").isin(sure))
    return j.where(better & ~F.col("x").isin(sure)).groupBy("x").agg(F.max(F.struct("sy", "ny", "y")).alias("b")).select(F.col("x").alias("token"), F.col("b.y").alias("right"))


def _given_table() -> dict[str, str]:
    """Nickname -> candidates of the full name, first letters joined by '|'."""
    out: dict[str, list[str]] = {}
    for full, nicks in NICKNAMES.items():
        for n in nicks.split():
            out.setdefault(n, []).append(full)
    return {k: "|".join(v) for k, v in out.items()}


_NICK = _given_table()
#: Degrees and generations, only behind the name: "J. D." before a surname are initials.
_DEGREES = re.compile(r"(?:[,\s]+(?:Ph\.?\s?D|J\.?\s?D|M\.?\s?D|LL\.?\s?M|S\.?J\.?D|Jr|Sr|III|II|IV|Esq)\b\.?)+\s*$", re.I)
PARSED = "kind string, surname string, given string, first string, middle string, key string"


def _is_institution(tokens: list[str]) -> bool:
    return any(t in _KIND and len(t) > 2 for t in tokens) and len(tokens) >= 3 and len([t for t in tokens if t not in SMALL]) >= 3


def _split_person(name: str) -> tuple[list[str], list[str]]:
    """Words of the given names and of the surname of a person."""
    body = _DEGREES.sub("", name).strip(" ,")
    if "," in body:
        last, _, rest = body.partition(",")
        front, back = name_tokens(rest), name_tokens(last)
    else:
        words = name_tokens(body)
        front, back = words[:-1], words[-1:]
    # particles and double surnames stay with the surname
    return [t for t in front if t not in TITLES], [t for t in back if t not in TITLES]


def _parts(name: str) -> tuple[str, str, str]:
    """(kind, surname, first given name as typed)."""
    if _is_institution(name_tokens(name)):
        return "institution", "", ""
    front, back = _split_person(name)
    return ("person", " ".join(back), front[0] if front else "") if back else ("other", "", "")


def parse_name(name: str, right: dict[str, str]) -> tuple:
    """(kind, surname, given, initial, middle initial, key).

    ``given`` is the full given name or several joined by '|' where a nickname
    has several; empty where only an initial is known.
    """
    fix = lambda w: right.get(w, w)
    tokens = [fix(t) for t in name_tokens(name)]
    if _is_institution(tokens):
        small = lambda t: t in SMALL or (len(t) <= 4 and t not in _KIND and any(within_one(t, w) for w in ("for", "and", "the", "law")))
        words = sorted({_KIND.get(t, t) for t in tokens if not small(t)})
        return "institution", "", "", "", "", "i:" + " ".join(words)
    front, back = _split_person(name)
    surname = " ".join(fix(t) for t in back)
    if not surname:
        return "other", "", "", "", "", "o:" + name.lower()
    if not front:
        return "person", surname, "", "", "", ""
    if len(front[0]) == 1:
        given = ""
    else:
        given = fix(front[0])
        given = _NICK.get(given, given)
    first = front[0][0] if not given else "".join(sorted({g[0] for g in given.split("|")}))
    middle = front[1][0] if len(front) > 1 else ""
    return "person", surname, given, first, middle, ""


def parsed_names(names: DataFrame, right: DataFrame) -> DataFrame:
    """names with the parts of PARSED; the corrections of a name's own tokens travel with it."""
    words = F.regexp_extract_all(F.lower(F.replace("name", F.lit("’"), F.lit("'"))), F.lit(r"[\p{L}]+(?:'[\p{L}]+)*"), F.lit(0))
    each = names.select("name", F.explode(F.array_distinct(words)).alias("token")).join(right, "token")
    own = each.groupBy("name").agg(F.collect_list(F.struct("token", "right")).alias("fixes"))

    @F.pandas_udf(PARSED)
    def parse(name: pd.Series, fixes: pd.Series) -> pd.DataFrame:
        rows = [parse_name(n, {f["token"]: f["right"] for f in fx} if fx is not None else {}) for n, fx in zip(name, fixes)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PARSED.split(", ")])

    return names.join(own, "name", "left").withColumn("p", parse("name", "fixes")).select("name", "n", "p.*")


def author_entities(parsed: DataFrame) -> DataFrame:
    """(name, entity): the person or institution each spelling stands for, where one is certain.

    Persons are the distinct (surname, given, middle) of spellings with a full
    given name. A spelling without a middle initial belongs to the person of
    its surname and given name where only one has a middle initial; one with
    an initial only, or an ambiguous nickname, to the only person it fits.
    """
    inst = parsed.where("kind <> 'person'").select("name", F.col("key").alias("entity"))
    people = parsed.where("kind = 'person'")
    whole = people.where("given <> '' and given not like '%|%'")
    # short forms such as "Nic" stand for the full name they begin
    full = whole.groupBy("surname", "given").agg(F.min(F.when(F.col("middle") != "", F.col("middle"))).alias("lo"), F.max(F.when(F.col("middle") != "", F.col("middle"))).alias("hi"), F.max((F.col("middle") == "").cast("int")).alias("bare"))
    starts = F.transform(F.sequence(F.lit(2), F.least(F.lit(4), F.length("given") - 1)), lambda n: F.left("given", n))
    short = full.where(F.length("given") > 2).select("surname", F.col("given").alias("long"), F.explode(starts).alias("given"))
    short = short.groupBy("surname", "given").agg(F.min("long").alias("lo_long"), F.max("long").alias("hi_long")).where("lo_long = hi_long").select("surname", "given", F.col("lo_long").alias("long"))
    whole = stage(whole.join(short, ["surname", "given"], "left").withColumn("given", F.coalesce("long", "given")).drop("long"), "whole")
    full = whole.groupBy("surname", "given").agg(F.min(F.when(F.col("middle") != "", F.col("middle"))).alias("lo"), F.max(F.when(F.col("middle") != "", F.col("middle"))).alias("hi"), F.max((F.col("middle") == "").cast("int")).alias("bare"))
    # with one middle initial, spellings with and without it are one person; with several, the bare one is its own
    one = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    persons = stage(
        full.where("lo is not null and lo = hi").select("surname", "given", F.col("lo").alias("middle"), F.lit(True).alias("sole"))
        .unionAll(full.where("lo is null").select("surname", "given", F.lit("").alias("middle"), F.lit(True).alias("sole")))
        .unionAll(whole.join(full.where("lo <> hi").select("surname", "given"), ["surname", "given"], "left_semi").select("surname", "given", "middle").distinct().withColumn("sole", F.lit(False))),
        "persons",
    )
    entity = F.concat(F.lit("p:"), "surname", F.lit(","), "given", F.lit(","), "middle")
    home = full.select("surname", "given", F.coalesce(one, F.lit("")).alias("sole_middle"), F.coalesce(F.col("lo") != F.col("hi"), F.lit(False)).alias("several"))
    direct = whole.join(home, ["surname", "given"]).withColumn("middle", F.when(F.col("several"), F.col("middle")).otherwise(F.col("sole_middle"))).select("name", entity.alias("entity"))
    # the rest: initials, ambiguous nicknames and bare surnames. Of the persons of a surname with an initial or a given
    # name, the least and the greatest are enough to know whether it is one
    rest = people.where("given = '' or given like '%|%'").select("name", "surname", "first", "middle", F.when(F.col("given") != "", F.split("given", r"\|")).alias("givens"))
    who = F.concat(F.lit("p:"), "surname", F.lit(","), "given", F.lit(","), "middle")
    named = F.explode(F.array(F.concat(F.lit("i:"), F.substring("given", 1, 1)), F.concat(F.lit("g:"), "given")))
    p = stage(persons.select("surname", named.alias("by"), "middle", who.alias("who"), (F.col("sole") & (F.col("middle") == "")).alias("bare")), "known")
    ends = lambda *what: [f.alias(n + k) for n, c in what for f, k in ((F.min(c), "_lo"), (F.max(c), "_hi"))]
    # any of them; those with a middle initial; those without one who are alone with their given name
    any_one = p.groupBy("surname", "by").agg(*ends(("a", F.col("who")), ("c", F.when(F.col("bare"), F.col("who")))))
    same = p.groupBy("surname", "by", "middle").agg(*ends(("b", F.col("who"))))
    asked = F.explode(F.when(F.col("givens").isNotNull(), F.transform("givens", lambda g: F.concat(F.lit("g:"), g))).otherwise(F.array(F.concat(F.lit("i:"), "first"))))
    fits = rest.withColumn("by", asked).join(any_one, ["surname", "by"]).join(same, ["surname", "by", "middle"], "left")
    # a middle initial that is given has to agree; a sole person without one may have one
    plain = F.col("middle") == ""
    lo, hi = (F.when(plain, F.col(f"a_{k}")).otherwise((F.least if k == "lo" else F.greatest)(f"b_{k}", f"c_{k}")) for k in ("lo", "hi"))
    by = fits.groupBy("name").agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"), F.min("b_lo").alias("elo"), F.max("b_hi").alias("ehi")).where("lo is not null")
    sure = F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("elo") == F.col("ehi"), F.col("elo"))
    resolved = by.select("name", sure.alias("entity")).where("entity is not null")
    lonely = rest.join(by.select("name"), "name", "left_anti").where("first <> ''").select("name", F.concat(F.lit("q:"), "surname", F.lit(","), F.coalesce(F.array_join("givens", "|"), F.col("first")), F.lit(","), "middle").alias("entity"))
    return inst.unionAll(direct).unionAll(resolved).unionAll(lonely)


def author_links(entities: DataFrame) -> DataFrame:
    """(name_a, name_b) of different spellings of one entity, the form TESTDATA.md asks for."""
    e = stage(entities, "entities")
    a, b = e.select("entity", F.col("name").alias("name_a")), e.select("entity", F.col("name").alias("name_b"))
    # code point order is the byte order of UTF-8
    return a.join(b, "entity").where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")


def _registry_index(names: list[str]) -> list[tuple[str, list[str]]]:
    return [(n, journal_words(n)) for n in names]


def _word_cost(typed: str, word: str, right: dict[str, set[str]]) -> float:
    """0 same, 0.1 abbreviation, 1 a typing error, 9 another word; what is a typing error of what is told by the joined pairs (``right``)."""
    if typed == word:
        return 0.0
    if JOURNAL_WORDS.get(typed) == word or (len(typed) < len(word) and word.startswith(typed.rstrip("'"))):
        return 0.1 if len(typed) <= 5 or JOURNAL_WORDS.get(typed) == word else 0.5
    meant = right.get(typed, ())
    if word in meant:
        return 1.0
    # an abbreviation with a typing error
    return 1.2 if any(JOURNAL_WORDS.get(m) == word or (len(m) >= 3 and word.startswith(m)) for m in meant) else 9.0


def match_journal(name: str, registry: list[tuple[str, list[str]]], right: dict[str, set[str]]) -> str | None:
    """The registry's name whose words are those of ``name`` in order or turned around a place, or None."""
    typed = journal_words(name)
    if not typed:
        return None
    orders = {tuple(typed), (*typed[-1:], *typed[:-1]), (*typed[1:], *typed[:1])}
    scored = []
    for full, words in registry:
        if len(words) != len(typed):
            # a small word typed wrong ("nd", "fo") counts as a word of its own
            if len(typed) != len(words) + 1:
                continue
        best = 99.0
        for order in orders:
            tries = [order] if len(order) == len(words) else [order[:i] + order[i + 1 :] for i in range(len(order)) if len(order[i]) <= 4 and any(within_one(order[i], s) for s in ("and", "the", "of", "at", "for", "in"))]
            for t in tries:
                cost = 0.0
                for a, b in zip(t, words):
                    cost += _word_cost(a, b, right)
                    if cost >= best or cost > 3:
                        break
                else:
                    best = min(best, cost + (len(order) != len(words)))
        if best <= 3:
            scored.append((best, full))
    scored.sort()
    if not scored or (len(scored) > 1 and scored[1][0] < scored[0][0] + 0.5 and scored[0][0] > 0):
        return None
    return scored[0][1]


def journal_links(names: DataFrame, registry: DataFrame, right: DataFrame) -> DataFrame:
    """(name, journal): spellings of holdings.journal with the registry's journal they stand for."""
    known = registry.select(F.trim("journal_name").alias("j")).where("j <> ''").distinct()
    # the registry is configuration of fixed size (TESTDATA.md); its names go to the workers
    index = _registry_index(sorted(r[0] for r in known.collect()))
    vocabulary = frozenset(w for _, words in index for w in words)
    places: dict[str, list] = {}
    for entry in index:
        for w in entry[1]:
            places.setdefault(w, []).append(entry)

    def candidates(word: str, meant: set[str]) -> list:
        """Listed journals with the word; with one it may be an error of, unless it begins a listed word and may be an abbreviation."""
        full = written_out(word, vocabulary)
        if full in places:
            return places[full]
        if word in JOURNAL_WORDS or any(w.startswith(word) for w in vocabulary):
            return []
        return list({e[0]: e for m in meant for e in places.get(m, ())}.values())

    @F.pandas_udf("string")
    def match(name: pd.Series, fixes: pd.Series) -> pd.Series:
        out = []
        for n, fx in zip(name, fixes):
            right: dict[str, set[str]] = {}
            for f in fx if fx is not None else ():
                right.setdefault(f["token"], set()).add(f["right"])
            # the rarest of its words, as typed or meant, names the cell; a name without one is no listed journal's
            cells = [cell for t in journal_words(n) if (cell := candidates(t, right.get(t, ())))]
            out.append(match_journal(n, min(cells, key=len, default=[]), right))
        return pd.Series(out, dtype=object)

    words = F.regexp_extract_all(F.lower(F.replace("name", F.lit("’"), F.lit("'"))), F.lit(r"[\p{L}]+(?:'[\p{L}]+)*"), F.lit(0))
    each = names.select("name", F.explode(F.array_distinct(words)).alias("token")).join(right, "token")
    own = each.groupBy("name").agg(F.collect_list(F.struct("token", "right")).alias("fixes"))
    return names.join(own, "name", "left").select("name", match("name", "fixes").alias("journal")).where("journal is not null")


def find(holdings: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entities of author names, journals): see author_entities and journal_links."""
    authors, journals = stage(author_names(holdings), "authors"), stage(spellings(holdings.select(F.col("journal").alias("name"))), "journals")
    listed = registry.select(F.trim("journal_name").alias("name")).where("name <> ''").distinct().withColumn("n", F.lit(1).cast("bigint"))
    tokens = stage(token_table(authors), "tokens")
    fixes = stage(corrections(tokens, differing_words(radius_join(stage(whole_names(authors), "forms")))), "fixes")
    # the registry is configuration of fixed size
    vocabulary = frozenset(w for r in listed.collect() for w in journal_words(r.name))
    pairs = differing_words(radius_join(stage(whole_journals(journals, listed, vocabulary), "jforms")))
    shown = F.col("y").isin(sorted({*vocabulary, *JOURNAL_WORDS, *(x for w in vocabulary for x in shortened(w))}))
    jfixes = stage(pairs.where(shown & ~F.col("x").isin(sorted(vocabulary))).select(F.col("x").alias("token"), F.col("y").alias("right")), "jfixes")
    # staged: the parts of a name are asked for many times
    return author_entities(stage(parsed_names(authors, fixes), "parsed")), journal_links(journals, registry, jfixes)


def members(entities: DataFrame, journals: DataFrame) -> DataFrame:
    """(field, name, entity, links): every spelling with its class and the number of other spellings in it."""
    both = entities.select(F.lit("authors").alias("field"), "name", "entity").unionAll(journals.select(F.lit("journal").alias("field"), "name", F.col("journal").alias("entity")))
    size = both.groupBy("field", "entity").agg((F.count("*") - 1).alias("links"))
    return both.join(size, ["field", "entity"]).select("field", "name", "entity", "links")


def found(entities: DataFrame, journals: DataFrame) -> DataFrame:
    """(field, name_a, name_b), name_a before name_b by code point, each pair once."""
    a = author_links(entities).select(F.lit("authors").alias("field"), "name_a", "name_b")
    j = journals.where("name <> journal").select(F.lit("journal").alias("field"), F.least("name", "journal").alias("name_a"), F.greatest("name", "journal").alias("name_b")).distinct()
    return a.unionAll(j)
