"""Duplicates, registries, holdings: groups that keys tie together, and the rows that stand for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import records as R
from corpusloom.functions import urls as U
from corpusloom.functions.text import plain_name
from corpusloom.operators.components import components
from corpusloom.session import stage


def star_edges(keys: DataFrame, node: str, key: str) -> DataFrame:
    """(src, dst): every node to the least node of each key it shares; n - 1 edges for n nodes."""
    low = keys.groupBy(key).agg(F.min(node).alias("dst"), F.max(node).alias("top")).where(F.col("dst") < F.col("top"))
    return keys.join(low, key).where(F.col(node) > F.col("dst")).select(F.col(node).alias("src"), "dst")


def duplicate_members(pdfs: DataFrame) -> DataFrame:
    """(path, canonical_path, reasons, group_size): every PDF that has copies, by shared hash, title with first text, or versioned name.

    Canonical is the newest, then larger, then longer, then smaller path. One row
    per member and aggregates only, since a group may hold a third of all PDFs.
    """
    stem = F.regexp_replace(F.regexp_replace("path", r"^.*/", ""), r"\.[A-Za-z0-9]{1,5}$", "")
    base = F.regexp_replace(stem, r"-[0-9]+$", "")
    k = F.array(
        F.struct(F.lit("sha256").alias("reason"), F.lower("sha256").alias("k")),
        F.struct(F.lit("title_first_text").alias("reason"), F.when(F.col("title_key").isNotNull() & F.col("first_text_hash").isNotNull(), F.concat_ws("\x01", "title_key", "first_text_hash")).alias("k")),
        F.struct(F.lit("versioned_name").alias("reason"), F.when(F.col("journal_domain").isNotNull(), F.concat_ws("\x01", F.col("journal_domain"), base)).alias("k")),
    )
    keys = pdfs.select("pdf_id", F.explode(k).alias("x")).where("x.k is not null and x.k <> ''")
    keys = stage(keys.select("pdf_id", "x.reason", F.xxhash64("x.reason", "x.k").alias("k1"), F.xxhash64(F.lit(7), "x.reason", "x.k").alias("k2")), "dupkeys")
    low = keys.groupBy("k1", "k2").agg(F.min("pdf_id").alias("dst"), F.max("pdf_id").alias("top")).where("dst < top").drop("top")
    tied = stage(keys.join(low, ["k1", "k2"]).select("pdf_id", "reason", "dst"), "duptied")
    roots = components(tied.where("pdf_id > dst").select(F.col("pdf_id").alias("src"), "dst")).withColumnRenamed("id", "pdf_id")
    why = tied.join(roots, "pdf_id").groupBy("root").agg(F.array_join(F.array_sort(F.collect_set("reason")), "|").alias("reasons"))
    rank = F.struct(F.coalesce("mtime", F.lit(0.0)).alias("mtime"), F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("page_count", F.lit(0)).alias("pages"))
    m = stage(pdfs.join(roots, "pdf_id").select("root", "path", rank.alias("rank")), "dupmembers")
    best = m.groupBy("root").agg(F.max("rank").alias("best"), F.count("*").alias("group_size"))
    first = m.join(best, "root").where(F.col("rank") == F.col("best")).groupBy("root", "group_size").agg(F.min("path").alias("canonical_path"))
    return m.join(first, "root").join(why, "root").select("path", "canonical_path", "reasons", "group_size")


def domain_medians(pdfs: DataFrame) -> DataFrame:
    """Count and medians of size and pages of every site; zeros and NULLs do not count."""
    pos = lambda c: F.when(F.col(c) > 0, F.col(c))
    return pdfs.groupBy("journal_domain").agg(F.count("*").alias("n"), F.coalesce(F.median(pos("size")), F.lit(0.0)).alias("median_size"), F.coalesce(F.median(pos("page_count")), F.lit(0.0)).alias("median_pages"))


def volume_suspects(pdfs: DataFrame) -> DataFrame:
    """PDFs that look like whole volumes beside the others of their site, with the reasons."""
    m = domain_medians(pdfs).where("n > 1")
    name = F.lower(F.regexp_replace("path", r"^.*/", ""))
    why = F.array(
        F.when(name.rlike(r"(?:full|complete|entire)[-_ ]?(?:issue|volume)|^vol[0-9]+[-_.]"), "filename"),
        F.when((F.col("median_size") > 0) & (F.col("size") > 5 * F.col("median_size")) & (F.col("size") > 10 * 1024 * 1024), "size"),
        F.when((F.col("page_count") > 150) & (F.col("median_pages") > 0) & (F.col("median_pages") < 40), "pages"),
    )
    j = pdfs.join(m, "journal_domain").withColumn("why", F.filter(why, lambda x: x.isNotNull()))
    return j.where(F.size("why") > 0).select("pdf_id", F.array_join("why", "|").alias("reasons"))


def path_shard(path, shards: int):
    """Shard of a path by the first 16 hexadecimal digits of its SHA-1."""
    return (F.conv(F.substring(F.sha1(path), 1, 16), 16, 10).cast("decimal(20,0)") % shards).cast("int")


def registry_index(registry: DataFrame) -> DataFrame:
    """Distinct (host, journal, slug) of the registry."""
    host = F.coalesce(F.nullif(U.host(F.col("host")), F.lit("")), U.host(F.col("url")))
    r = registry.select(host.alias("host"), R.text(F.col("journal_name")).alias("journal"), U.slug(F.col("url")).alias("slug"))
    return r.where("host <> '' and journal <> ''").distinct()


def infer_journals(rows: DataFrame, index: DataFrame) -> DataFrame:
    """rows (host, contexts, ...) with ``journal``: the one of the host that a context names, else the host's only one, else a label."""
    per_host = index.groupBy("host").agg(F.collect_set(F.struct("slug", "journal")).alias("_known"))
    j = rows.join(per_host, "host", "left")
    known = F.coalesce("_known", F.expr("array()").cast("array<struct<slug:string,journal:string>>"))
    named = F.array_distinct(F.transform(F.filter(known, lambda k: F.array_contains("contexts", k["slug"])), lambda k: k["journal"]))
    every = F.array_distinct(F.transform(known, lambda k: k["journal"]))
    label = F.when(F.size("contexts") > 0, F.concat(F.get("contexts", F.lit(0)), F.lit(" ("), F.coalesce("host", F.lit("")), F.lit(")"))).otherwise(F.coalesce(F.nullif("host", F.lit("")), F.lit("(unknown journal)")))
    return j.withColumn("journal", F.when(F.size(named) == 1, F.get(named, F.lit(0))).when(F.size(every) == 1, F.get(every, F.lit(0))).otherwise(label)).drop("_known")


def holdings(runs: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per file: of the records of a hash, address or path the best described, the first of equals."""
    m = F.col("metadata")
    ok = runs.where("coalesce(ok, false) or download_state = 'downloaded'")
    sha, url, path = R.text(F.col("pdf_sha256")), F.coalesce(R.filled(F.col("pdf_url")), R.text(m["url"])), R.text(F.col("local_path"))
    r = ok.select(
        "seq", "record_id", F.coalesce(F.nullif(U.host(F.col("domain")), F.lit("")), U.host(url)).alias("host"), R.contexts(F.col("pdf_url"), F.col("page_url"), m["url"], m["dc_set_spec"]).alias("contexts"),
        R.text(m["title"]).alias("title"), R.author_text(m["authors"]).alias("authors"), R.year(m["year"], m["date"]).alias("year"), url.alias("pdf_url"), path.alias("local_path"), sha.alias("sha"),
        F.coalesce(F.nullif(sha, F.lit("")), F.nullif(url, F.lit("")), F.nullif(path, F.lit(""))).alias("identity"),
    ).where("identity is not null")
    score = F.struct((F.col("title") != "").cast("int"), (F.col("authors") != "").cast("int"), (F.col("year") != "").cast("int"), -F.col("seq"), -F.col("record_id"))
    best = r.groupBy("identity").agg(F.max_by(F.struct("record_id", "host", "contexts", "title", "authors", "year", "pdf_url", "local_path", "sha"), score).alias("b")).select("identity", "b.*")
    return infer_journals(best, registry_index(registry))


def registry_groups(registry: DataFrame) -> DataFrame:
    """(seq, group_seq): registry rows tied by journal name (without marks, case and article) or external number."""
    r = registry.select("seq", plain_name(F.col("journal_name")).alias("name"), R.filled(F.col("wlu_mainid")).alias("wlu")).where("name <> ''")
    # staged: the key of the union is computed once
    r = stage(r, "registry")
    keys = r.select("seq", F.concat(F.lit("n:"), "name").alias("key")).unionAll(r.where("wlu is not null and wlu <> 'n/a'").select("seq", F.concat(F.lit("w:"), "wlu").alias("key")))
    roots = components(star_edges(keys, "seq", "key"))
    return r.select("seq").join(roots, F.col("seq") == F.col("id"), "left").select("seq", F.coalesce("root", "seq").alias("group_seq"))


def unique_hosts(registry: DataFrame) -> DataFrame:
    """(host, journal): hosts that carry one journal only, by which a record may be matched."""
    return registry_index(registry).groupBy("host").agg(F.count_distinct("journal").alias("n"), F.min("journal").alias("journal")).where("n = 1").select("host", "journal")


def rank_by(rows: DataFrame, key: str, weights: dict[str, float]) -> DataFrame:
    """(rank, key, score): columns scaled by their maximum, weighted and summed; ties by key."""
    top = rows.agg(*[F.greatest(F.max(c), F.lit(1)).alias(f"_{c}") for c in weights])
    total = F.lit(0.0)
    for c, w in weights.items():
        total = total + F.lit(w) * F.coalesce(F.col(c), F.lit(0)) / F.col(f"_{c}")
    scored = rows.join(F.broadcast(top)).select(key, F.round(total, 6).alias("score"))
    return ranked(scored, [F.desc("score"), F.col(key)]).select("rank", key, "score")


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """rows with ``rank``, their place in the order: sorted by ranges, each of which counts on from those before it."""
    parts = stage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    # one row per partition of the sort
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(offsets, "_part").withColumn("rank", (F.col("_before") + place).cast("int")).drop("_part", "_before")


def spread(rows: DataFrame, group: str, order: list[str], key: str) -> DataFrame:
    """(group, key, place): first, quarter, middle, three-quarter and last row of every group."""
    w = Window.partitionBy(group)
    r = rows.select(group, key, (F.row_number().over(w.orderBy(*order)) - 1).alias("i"), F.count("*").over(w).alias("n"))
    at = F.array(F.lit(0), F.floor(F.col("n") / 4), F.floor(F.col("n") / 2), F.floor(F.col("n") * 3 / 4), F.col("n") - 1).cast("array<bigint>")
    return r.where(F.array_contains(at, F.col("i").cast("bigint"))).select(group, key, F.col("i").alias("place"))


def versioned_names(rows: DataFrame, group: str, path: str, key: str) -> DataFrame:
    """(key, name): file names without collisions inside a group; later ones get ``__vN``."""
    name = F.regexp_replace(path, r"^.*/", "")
    stem, ext = F.regexp_replace(name, r"\.[A-Za-z0-9]{1,5}$", ""), F.regexp_extract(name, r"(\.[A-Za-z0-9]{1,5})$", 1)
    r = rows.select(group, key, stem.alias("stem"), ext.alias("ext"))
    n = F.row_number().over(Window.partitionBy(group, "stem", "ext").orderBy(key))
    return r.withColumn("n", n).select(key, F.concat("stem", F.when(F.col("n") > 1, F.concat(F.lit("__v"), F.col("n"))).otherwise(""), "ext").alias("name"))


def quotas(counts: DataFrame, group: str, size: int, floor: int) -> DataFrame:
    """(group, quota): ``size`` places shared out over groups with ``n`` members, each group first up to ``floor``.

    The places of the floors are handed out in turns, as far as ``size`` goes; the
    others in proportion to the members left, whole parts first and then one
    each for the largest remainders. Ties go by name. One row per group.
    """
    n = counts.where("n > 0").select(group, F.col("n").cast("bigint").alias("n"))
    target = n.agg(F.least(F.lit(size), F.coalesce(F.sum("n"), F.lit(0))).alias("target"))
    turns = n.where(F.lit(floor) > 0).select(group, F.explode(F.sequence(F.lit(1), F.least(F.lit(max(floor, 1)), F.col("n").cast("int")))).alias("turn"))
    turns = turns.withColumn("at", F.row_number().over(Window.orderBy("turn", group))).join(F.broadcast(target)).where("at <= target").groupBy(group).agg(F.count("*").alias("base"))
    got = n.join(turns, group, "left").select(group, F.coalesce("base", F.lit(0)).alias("base"), (F.col("n") - F.coalesce("base", F.lit(0))).alias("room")).join(F.broadcast(target))
    every = Window.partitionBy()
    got = got.withColumns({"left": F.col("target") - F.sum("base").over(every), "total": F.greatest(F.lit(1), F.sum("room").over(every))})
    got = got.withColumns({"whole": F.expr("left * room div total"), "part": F.expr("left * room % total")})
    got = got.withColumns({"spare": F.col("left") - F.sum("whole").over(every), "at": F.row_number().over(Window.orderBy(F.desc("part"), group))})
    return got.select(group, (F.col("base") + F.col("whole") + (F.col("at") <= F.col("spare")).cast("int")).alias("quota")).where("quota > 0")


def drawn(rows: DataFrame, group: str, key: str, quota: DataFrame, seed: int) -> DataFrame:
    """(group, key): of every group as many rows as its quota, in a seeded order that any engine can repeat (MD5 of seed and key)."""
    w = Window.partitionBy(group).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key)
    return rows.join(quota, group).withColumn("_at", F.row_number().over(w)).where("_at <= quota").select(group, key)
