"""Normalisation of timestamps of mixed formats, precisions and time zones.

Every value is tokenised on the JVM into a *shape mask* of character classes
(``9`` digit, ``b`` month name, ``w`` weekday, ``s`` season, ``n`` zone name,
``p`` AM/PM, ``r`` roman number, ``a`` any other word). A mask is mapped to a
parser once per Python worker; a parser converts all values of its mask in
vectors, and local clock times pass through zone transition tables that are
built once on the driver and carry the version of the zone database.

Defined results: a NULL, empty or blank value has status ``empty``; what no
parser knows has ``unparsed``; a form that is known but denotes no possible
date has ``impossible``; a local time that occurs twice has ``ambiguous`` and
one that was skipped ``nonexistent``; a local time without a known zone has
``no_zone``; a numeric date whose order cannot be decided has ``ambiguous``;
a span of years has ``span``. ``normal`` is NULL in all of these.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Years outside of these are no dates of publications or retrievals.
FIRST_YEAR, LAST_YEAR = 1500, 2099

RESULT = "normal string, precision string, status string"

# Names of months, weekdays and seasons, roman digits, and the
# offsets of zone abbreviations where the host's own zone does not use them.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
MONTH_WORDS = (
    "JAN(?:UARY)?|FEB(?:RUARY)?|MAR(?:CH)?|APR(?:IL)?|MAY|JUNE?|JULY?|AUG(?:UST)?|SEP(?:T(?:EMBER)?)?"
    "|OCT(?:OBER)?|NOV(?:EMBER)?|DEC(?:EMBER)?"
)
DAY_WORDS = "MON(?:DAY)?|TUE(?:S(?:DAY)?)?|WED(?:NESDAY)?|THU(?:R(?:S(?:DAY)?)?)?|FRI(?:DAY)?|SAT(?:URDAY)?|SUN(?:DAY)?"
SEASON_WORDS = "SPRING|SUMMER|AUTUMN|FALL|WINTER"
ROMAN = {"M": 1000, "D": 500, "C": 100, "L": 50, "X": 10, "V": 5, "I": 1}
ZONE_OFFSETS = {
    "UTC": 0, "GMT": 0, "UT": 0, "Z": 0, "WET": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "BST": 60, "WEST": 60, "CET": 60,
    "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "JST": 540, "KST": 540, "AWST": 480, "ACST": 570,
    "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
}


# ---------------------------------------------------------------- masks (JVM)
def cleaned(value: Column) -> Column:
    """Upper case, ASCII digits, plain and single spaces, trimmed."""
    plain = F.regexp_replace(value, r"[\s\x{00A0}\x{2000}-\x{200B}\x{202F}\x{3000}\x{FEFF}]+", " ")
    return F.upper(F.trim(F.translate(plain, "０１２３４５６７８９", "0123456789")))


def shape_mask(clean: Column) -> Column:
    steps = [
        (r"^[MDCLXVI]{2,15}$", "r"),
        (rf"(?<![A-Z])(?:{MONTH_WORDS})(?![A-Z])", "b"),
        (rf"(?<![A-Z])(?:{DAY_WORDS})(?![A-Z])", "w"),
        (rf"(?<![A-Z])(?:{SEASON_WORDS})(?![A-Z])", "s"),
        (r"(?<=[0-9] ?)(?:AM|PM|A\.M\.|P\.M\.)(?![A-Z])", "p"),
        (r"(?<=[0-9])(?:ST|ND|RD|TH)(?![A-Z])", "o"),
        (r"(?<=[0-9])T(?=[0-9])", "t"),
        (r"(?<=[0-9])Z$", "z"),
        (r"(?<=[0-9] ?)[A-Z]{2,5}$", "n"),
        (r"[A-Z]+", "a"),
        (r"[0-9]", "9"),
    ]
    for pattern, mark in steps:
        clean = F.regexp_replace(clean, pattern, mark)
    return clean


def host_key(*sources: Column) -> Column:
    """Host in one spelling, from the first source that has one."""

    def one(c: Column) -> Column:
        c = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", "")
        c = F.regexp_replace(F.regexp_replace(c, r"[/?#:].*$", ""), r"^www\.|\.+$", "")
        return F.when(c != "", c)

    return F.coalesce(*[one(c) for c in sources])


# ------------------------------------------------------- zone transition tables
def zone_version() -> str:
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "system"


def zone_tables(names: list[str], first: int = 1900, last: int = 2101) -> dict:
    """``{version, zones: {name: (starts, offsets, {abbreviation: offset})}}``.

    ``starts`` are UTC seconds at which ``offsets`` (seconds) begin to hold.
    """
    from zoneinfo import ZoneInfo

    zones = {}
    start, end = datetime(first, 1, 1, tzinfo=timezone.utc), datetime(last, 1, 1, tzinfo=timezone.utc)
    for name in sorted(set(names)):
        try:
            zone = ZoneInfo(name)
        except Exception:
            continue
        offset = lambda t, z=zone: int(t.astimezone(z).utcoffset().total_seconds())
        starts, offsets, abbreviations = [np.iinfo(np.int64).min // 4], [offset(start)], {}
        t, o = start, offset(start)
        while t < end:
            after = t + timedelta(days=7)
            if (changed := offset(after)) != o:
                low, high = int(t.timestamp()), int(after.timestamp())
                while high - low > 1:
                    middle = (low + high) // 2
                    low, high = (middle, high) if offset(datetime.fromtimestamp(middle, timezone.utc)) == o else (low, middle)
                starts.append(high)
                offsets.append(changed)
            o, t = changed, after
            abbreviations[t.astimezone(zone).tzname()] = o
        zones[name] = (np.array(starts), np.array(offsets), {k.upper(): v for k, v in abbreviations.items() if k.isalpha()})
    return {"version": zone_version(), "zones": zones}


def local_to_utc(zone: tuple, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTC seconds, and how many instants (0, 1, 2) have that local time."""
    starts, offsets, _ = zone
    at = lambda t: offsets[np.searchsorted(starts, t, side="right") - 1]
    a, b = at(local - 93_600), at(local + 93_600)
    good_a, good_b = at(local - a) == a, (at(local - b) == b) & (a != b)
    return np.where(good_a, local - a, local - b), good_a.astype(int) + good_b.astype(int)


# -------------------------------------------------------------------- parsers
DATES = {
    "ymd": r"9999-99-99|9999/9{1,2}/9{1,2}|9999\.9{1,2}\.9{1,2}",
    "compact": r"99999999",
    "xxy": r"9{1,2}/9{1,2}/9999|9{1,2}-9{1,2}-9999",
    "dmy": r"9{1,2}\.9{1,2}\.9999",
    "bdy": r"b\.? 9{1,2}o?,? 9999|b-9{1,2}-9999",
    "dby": r"9{1,2}o? b\.?,? 9999|9{1,2}-b-9999|9{1,2}bo?9999",
    "ybd": r"9999 b\.? 9{1,2}|9999-b-9{1,2}",
}
TIMES = {"clock": r"9{1,2}:99(?::99(?:[.,]9{1,9})?)?", "half": r"9{1,2}:99(?::99)? ?p", "tight": r"999999|9999"}
ZONES = {"z": r" ?z", "offset": r" ?[+-]99:?99", "named": r" ?n"}
PERIODS = {
    "my": r"9{1,2}/9999",
    "by": r"b\.?,? 9999|b-9999",
    "yb": r"9999 b\.?",
    "ym": r"9999-99|9999/99",
    "sy": r"s,? 9999|9999 s",
    "span": r"9999 ?[-/–—] ?9999|9999 ?[–—] ?99",
    "y": r"9999|[\[(]9999[\])]|©? ?(?:a\.? ?)?9999|\[(?:a\.? ?)?9999\]",
    "y_words": r"9999,(?: a\.?)+",
    "vy": r"a\.? 9{1,4},? \(9999\)",
    "y0": r"9999\.9",
    "roman": r"r",
    "epoch": r"9{9,10}(?:\.9{1,9})?",
    "epoch_ms": r"9{13}",
}
_named = lambda rules: "|".join(f"(?P<{k}>{v})" for k, v in rules.items())
STAMP = re.compile(rf"(?:w\.?,? )?(?:{_named(DATES)})(?:,?[ t]{{1,2}}(?:{_named(TIMES)})(?:{_named(ZONES)})?)?")
PERIOD = re.compile(_named(PERIODS))


@lru_cache(maxsize=4096)
def parser_for(mask: str):
    """(date form, time form, zone form, sign, regex of the values), or None."""
    found = STAMP.fullmatch(mask) or PERIOD.fullmatch(mask)
    if not found:
        return None
    forms = {k for k, v in found.groupdict().items() if v is not None}
    pick = lambda rules: next((k for k in rules if k in forms), None)
    # "99999999" may be a date; ten or thirteen digits count seconds or milliseconds
    day, clock, zone = pick(DATES) or pick(PERIODS), pick(TIMES), pick(ZONES)
    text = {"b": "([A-Z]+)", "n": "([A-Z]+)", "p": "([AP])\\.?M\\.?", "r": "([A-Z]+)", "w": "[A-Z]+", "s": "[A-Z]+", "a": "[A-Z]+", "o": "[A-Z]+", "t": "T", "z": "Z"}
    value = re.sub(r"9+|[a-z]|[^9a-z]+", lambda m: f"([0-9]{{{len(m[0])}}})" if m[0][0] == "9" else text.get(m[0]) or re.escape(m[0]), mask)
    sign = -1 if zone == "offset" and found["offset"].strip()[0] == "-" else 1
    return day, clock, zone, sign, re.compile(value)


def _roman(word: str) -> float:
    n = 0
    for a, b in zip(word, [*word[1:], ""]):
        n += -ROMAN[a] if b and ROMAN[b] > ROMAN[a] else ROMAN[a]
    spelled, rest = "", n
    for size, letters in ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        spelled, rest = spelled + letters * (rest // size), rest % size
    return n if spelled == word else -1


def _month(words: pd.Series) -> np.ndarray:
    return words.str[:3].map({m: i + 1 for i, m in enumerate(MONTHS)}).fillna(0).to_numpy(float)


def _days(y, m, d) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 and whether the calendar has the date."""
    ok = (y >= FIRST_YEAR) & (y <= LAST_YEAR) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= 31)
    yy, mm, dd = (np.where(ok, x, z).astype(int) for x, z in ((y, 1970), (m, 1), (d, 1)))
    month = (yy - 1970) * 12 + mm - 1
    first = month.astype("datetime64[M]").astype("datetime64[D]").astype(int)
    length = (month + 1).astype("datetime64[M]").astype("datetime64[D]").astype(int) - first
    return first + dd - 1, ok & (dd <= length)


def _convert(mask: str, rows: pd.DataFrame, tables: dict, want: str) -> pd.DataFrame:
    """rows: clean, zone, order; all of one mask."""
    n, none = len(rows), np.full(len(rows), None, dtype=object)
    said = lambda status: pd.DataFrame({"normal": none, "precision": none, "status": status}, index=rows.index)
    if (parser := parser_for(mask)) is None:
        return said("unparsed")
    day, clock, zone, sign, pattern = parser
    if day == "span":
        return said("span")
    part = rows["clean"].str.extract(pattern)
    num = lambda i: pd.to_numeric(part[i], errors="coerce").to_numpy(float)
    status = np.full(n, "converted", dtype=object)
    seconds, precision, used = np.zeros(n), "day", 3
    ones = np.ones(n)
    if day in ("epoch", "epoch_ms"):
        # ten digits count seconds, thirteen milliseconds; fractions are cut off
        seconds = np.floor(num(0) / (1000 if day == "epoch_ms" else 1))
        year = seconds.astype("int64").astype("datetime64[s]").astype("datetime64[Y]").astype(int) + 1970
        status[(year < FIRST_YEAR) | (year > LAST_YEAR)] = "impossible"
        return _written(seconds, "second", status, want, n, rows.index)
    m = d = ones
    if day == "ymd":
        y, m, d = num(0), num(1), num(2)
    elif day == "compact":
        whole, used = num(0), 1
        y, m, d = whole // 10000, whole // 100 % 100, whole % 100
    elif day == "dmy":
        d, m, y = num(0), num(1), num(2)
    elif day == "xxy":
        a, b, y = num(0), num(1), num(2)
        order = rows["order"].fillna("").to_numpy()
        first_is_month = np.where(a > 12, False, np.where(b > 12, True, order == "mdy"))
        m, d = np.where(first_is_month, a, b), np.where(first_is_month, b, a)
        status[(a <= 12) & (b <= 12) & (a != b) & ~np.isin(order, ["mdy", "dmy"])] = "ambiguous"
    elif day == "bdy":
        m, d, y = _month(part[0]), num(1), num(2)
    elif day == "dby":
        d, m, y = num(0), _month(part[1]), num(2)
    elif day == "ybd":
        y, m, d = num(0), _month(part[1]), num(2)
    elif day == "my":
        m, y, precision = num(0), num(1), "month"
    elif day == "by":
        m, y, precision = _month(part[0]), num(1), "month"
    elif day == "yb":
        y, m, precision = num(0), _month(part[1]), "month"
    elif day == "ym":
        y, m, precision = num(0), num(1), "month"
    elif day == "vy":
        y, precision = num(1), "year"
    elif day == "roman":
        y, precision = part[0].map(_roman).to_numpy(float), "year"
    else:
        y, precision = num(0), "year"
        if day == "y0":
            status[num(1) != 0] = "unparsed"
    days, ok = _days(y, m, d)
    status[~ok & (status == "converted")] = "span" if day == "ym" else "impossible"
    seconds = days * 86400.0
    if clock:
        precision = "second"
        if clock == "tight":
            whole = num(used)
            long = part[used].str.len().to_numpy() == 6
            whole, used = np.where(long, whole, whole * 100), used + 1
            h, mi, s = whole // 10000, whole // 100 % 100, whole % 100
        else:
            h, mi, used = num(used), num(used + 1), used + 2
            s = np.zeros(n)
            if mask.count(":99") - (zone == "offset" and mask[-3] == ":") >= 2:
                s, used = num(used), used + 1
                if re.search(r":99[.,]9", mask):
                    used += 1  # fractions are cut off
            if clock == "half":
                late, used = (part[used] == "P").to_numpy(), used + 1
                status[((h < 1) | (h > 12)) & (status == "converted")] = "impossible"
                h = h % 12 + 12 * late
        # a leap second is written as the second before it
        status[((h > 23) | (mi > 59) | (s > 60)) & (status == "converted")] = "impossible"
        seconds = seconds + h * 3600 + mi * 60 + np.minimum(s, 59)
        if want == "instant":
            seconds = _to_utc(seconds, zone, sign, part, used, rows, tables, status)
    return _written(seconds, precision, status, want, n, rows.index)


def _to_utc(seconds, zone, sign, part, used, rows, tables, status):
    if zone == "z":
        return seconds
    if zone == "offset":
        digits = part[used].str.cat(part[used + 1]) if part.shape[1] > used + 1 else part[used]
        whole = pd.to_numeric(digits, errors="coerce").to_numpy(float)
        status[((whole // 100 > 18) | (whole % 100 > 59)) & (status == "converted")] = "impossible"
        return seconds - sign * (whole // 100 * 3600 + whole % 100 * 60)
    out, local = seconds.copy(), seconds.astype("int64")
    names = rows["zone"].fillna("").to_numpy()
    words = part[used].to_numpy() if zone == "named" else np.full(len(out), "", dtype=object)
    for name in set(names):
        known = tables["zones"].get(name)
        for word in set(words[names == name]):
            here = (names == name) & (words == word)
            if word:
                own = known[2].get(word) if known else None
                offset = own if own is not None else ZONE_OFFSETS[word] * 60 if word in ZONE_OFFSETS else None
                if offset is None:
                    status[here & (status == "converted")] = "no_zone"
                else:
                    out[here] = seconds[here] - offset
            elif known is None:
                status[here & (status == "converted")] = "no_zone"
            else:
                utc, count = local_to_utc(known, local[here])
                out[here] = utc
                state = status[here]
                state[(count == 2) & (state == "converted")] = "ambiguous"
                state[(count == 0) & (state == "converted")] = "nonexistent"
                status[here] = state
    return out


def _written(seconds, precision, status, want, n, index) -> pd.DataFrame:
    status = status.copy()
    if want == "instant" and precision != "second":
        status[status == "converted"] = "no_time"
    good = status == "converted"
    unit = {"instant": "s", "year": "Y"}.get(want) or {"year": "Y", "month": "M"}.get(precision, "D")
    stamps = np.where(good, seconds, 0).astype("int64").astype("datetime64[s]")
    text = np.datetime_as_string(stamps.astype(f"datetime64[{unit}]"), unit=unit).astype(object)
    if want == "instant":
        text = text + "Z"
    text[~good] = None
    level = np.full(n, {"Y": "year", "M": "month", "D": "day", "s": "second"}[unit], dtype=object)
    level[~good] = None
    return pd.DataFrame({"normal": text, "precision": level, "status": status}, index=index)


def converter(tables: dict, want: str):
    """Pandas UDF (clean, mask, zone, order) -> struct of normal, precision, status."""

    @F.pandas_udf(RESULT)
    def convert(clean: pd.Series, mask: pd.Series, zone: pd.Series, order: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame({"clean": clean, "zone": zone, "order": order})
        out = pd.DataFrame({"normal": None, "precision": None, "status": "empty"}, index=rows.index, dtype=object)
        filled = rows["clean"].fillna("").ne("")
        for shape, members in rows[filled].groupby(mask[filled], sort=False):
            out.loc[members.index] = _convert(shape, members, tables, want)
        return out

    return convert


def normalise(df: DataFrame, value: Column, want: str, host: Column | None = None, settings: DataFrame | None = None) -> DataFrame:
    """``df`` with a struct column ``stamp`` (value, mask, normal, precision, status).

    ``want``: ``instant`` (UTC, seconds), ``date`` (at its own precision) or
    ``year``. ``settings`` (host, time_zone, date_order) tells how a host writes;
    it is a table of configuration, one row per host. A host listed with
    contradicting settings counts as having none. Columns of ``df`` keep their
    names; one called ``stamp`` or beginning with ``_ts_`` must not exist.
    """
    df = df.withColumn("_ts_value", value.cast("string"))
    df = df.withColumn("_ts_clean", cleaned(F.col("_ts_value")))
    zones: list[str] = []
    if settings is not None and host is not None:
        one = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
        known = settings.select(host_key(F.col("host")).alias("_ts_host"), F.col("time_zone").alias("z"), F.lower(F.col("date_order")).alias("o"))
        known = known.where("_ts_host is not null").groupBy("_ts_host").agg(one("z").alias("_ts_zone"), one("o").alias("_ts_order"))
        # the names of one zone database, some hundred at most
        zones = [r[0] for r in known.select("_ts_zone").distinct().collect() if r[0]]
        df = df.withColumn("_ts_host", host).join(known, "_ts_host", "left")
    else:
        df = df.withColumns({"_ts_host": F.lit(None).cast("string"), "_ts_zone": F.lit(None).cast("string"), "_ts_order": F.lit(None).cast("string")})
    df = df.withColumn("_ts_mask", shape_mask(F.col("_ts_clean")))
    convert = converter(zone_tables(zones), want)
    got = convert("_ts_clean", "_ts_mask", "_ts_zone", "_ts_order")
    df = df.withColumn("_ts_got", got)
    stamp = F.struct(F.col("_ts_value").alias("value"), F.col("_ts_mask").alias("mask"), "_ts_got.normal", "_ts_got.precision", "_ts_got.status")
    return df.withColumn("stamp", stamp).drop("_ts_value", "_ts_clean", "_ts_mask", "_ts_host", "_ts_zone", "_ts_order", "_ts_got")


def all_stamps(holdings: DataFrame, runs: DataFrame, smoke: DataFrame, settings: DataFrame) -> DataFrame:
    """(src, rec_id, stamp) of the three kinds of strings; one row per record."""
    a = holdings.select(F.col("holding_id").alias("rec_id"), "host", "pdf_url", "retrieved_at")
    a = normalise(a, F.col("retrieved_at"), "instant", host_key(F.col("host"), F.col("pdf_url")), settings)
    b = runs.select(F.col("record_id").alias("rec_id"), "domain", "page_url", "seed_url", F.col("metadata.date").alias("date"))
    b = normalise(b, F.col("date"), "date", host_key(F.col("domain"), F.col("page_url"), F.col("seed_url")), settings)
    c = smoke.select(F.col("smoke_id").alias("rec_id"), "article_year")
    c = normalise(c, F.col("article_year"), "year")
    parts = [x.select(F.lit(src).alias("src"), "rec_id", "stamp") for src, x in (("retrieved_at", a), ("date", b), ("article_year", c))]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def found(stamps: DataFrame) -> DataFrame:
    changed = (F.col("stamp.status") == "converted") & (F.col("stamp.normal") != F.col("stamp.value"))
    return stamps.where(changed).select("src", "rec_id", F.col("stamp.normal").alias("normal"))
