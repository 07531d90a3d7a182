"""Queries over the timestamp operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import timestamps
from corpusloom.session import table


def _stamps(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.all_stamps(*[table(spark, d, t) for t in ("holdings", "run_records", "smoke_results", "host_settings")])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Values that denote exactly one date, year or instant, and are not yet written so."""
    return timestamps.found(_stamps(spark, d))


def p4_profile(spark: SparkSession, d: str) -> DataFrame:
    """Shape masks of every source with their outcomes."""
    s = _stamps(spark, d)
    return s.groupBy("src", F.col("stamp.mask").alias("mask"), F.col("stamp.status").alias("status")).agg(F.count("*").alias("n"), F.min("stamp.value").alias("example"), F.min("stamp.normal").alias("first_normal"))


#: Forms of dates that another engine reads alike: no zone, no order to choose, months by their names.
PLAIN = r"^[0-9]{1,2}[ -][A-Z][a-z]{2,8}[ -][0-9]{4}$|^[A-Z][a-z]{2,8} [0-9]{1,2}, [0-9]{4}$|^[0-9]{4}[/.][0-9]{1,2}[/.][0-9]{1,2}$|^[0-9]{1,2}/[0-9]{4}$|^\[[0-9]{4}\]$"


def p4_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates of records in plain forms, as the operator reads them among all others."""
    s = p4_found(spark, d).where("src = 'date'")
    plain = table(spark, d, "run_records").where(F.col("metadata.date").rlike(PLAIN)).select(F.col("record_id").alias("rec_id"))
    return s.join(plain, "rec_id", "left_semi").select("rec_id", "normal")


QUERIES = {"p4_found": p4_found, "p4_profile": p4_profile, "p4_dates": p4_dates}
_FORMS = ("%d %B %Y", "%d %b %Y", "%d-%B-%Y", "%d-%b-%Y", "%B %d, %Y", "%b %d, %Y", "%Y/%m/%d", "%Y.%m.%d")
SQL: dict[str, str] = {
    "p4_dates": f"""WITH v AS (SELECT record_id AS rec_id, metadata.date AS v FROM run_records WHERE regexp_matches(metadata.date, '{PLAIN}')),
        n AS (SELECT rec_id, CASE WHEN regexp_matches(v, '^\\[') THEN regexp_extract(v, '([0-9]{{4}})', 1) WHEN regexp_matches(v, '^[0-9]{{1,2}}/[0-9]{{4}}$') THEN regexp_extract(v, '([0-9]{{4}})$', 1) || '-' || lpad(regexp_extract(v, '^([0-9]{{1,2}})', 1), 2, '0')
          ELSE strftime(coalesce({', '.join(f"try_strptime(v, '{f}')" for f in _FORMS)}), '%Y-%m-%d') END AS normal FROM v)
        SELECT rec_id, normal FROM n WHERE normal IS NOT NULL""",
}
