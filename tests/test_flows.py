import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.record_stats import latest_retryable
from corpusloom.sources import readers, sinks
from corpusloom.streaming import cooldown, events, upsert


def test_cooldown_step():
    now, log = (0, 0.0, 0, 0), []
    for at, ok in ((0, False), (1, False), (2, False), (3, True), (4, False), (5, False), (6, False), (2000, False)):
        now, refused, opened = cooldown.step(now, at, ok, 3, 900)
        log.append((refused, opened, now[0]))
    assert log == [(False, False, 1), (False, False, 2), (False, True, 3), (True, False, 0), (False, False, 1), (False, False, 2), (False, True, 3), (False, False, 1)]
    assert now[2:] == (7, 1)


def test_cooldown_stream(spark, tmp_path):
    rows = [("a", i, False) for i in range(4)] + [("b", 0, True), ("b", 1, False)]
    df = spark.createDataFrame(rows, "key string, s bigint, ok boolean").select("key", F.timestamp_seconds("s").alias("ts"), "ok")
    df.write.parquet(str(tmp_path / "in"))
    out = cooldown.cooldowns(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), threshold=3, seconds=60)
    q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.key, r.ts.second, r.refused, r.opened, r.streak) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 0, False, False, 1), ("a", 1, False, False, 2), ("a", 2, False, True, 3), ("a", 3, True, True, 4), ("b", 0, False, False, 0), ("b", 1, False, False, 1)]


def test_cooldown_of_many_frames(spark, tmp_path):
    """A key whose batch comes in several Arrow frames and out of order is taken in order of time."""
    rows = [("a", (i * 37) % 500, (i * 37) % 500 % 5 == 4) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, s bigint, ok boolean").select("key", F.timestamp_seconds("s").alias("ts"), "ok")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        out = cooldown.cooldowns(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), threshold=4, seconds=3)
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    now, want = (0, 0.0, 0, 0), []
    for _, at, ok in sorted(rows, key=lambda r: r[1]):
        now, refused, opened = cooldown.step(now, at, ok, 4, 3)
        want.append((at, refused, opened, now[0]))
    got = [(int(r.ts.timestamp()), r.refused, r.opened, r.streak) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("ts").collect()]
    assert got == want


def test_upsert_does_not_take_a_broken_table_for_an_empty_one(spark, tmp_path):
    schema = "record_id bigint, seq bigint, domain string, pdf_url string, ok boolean, http_status int, download_state string, retries int"
    batch = spark.createDataFrame([(1, 1, "d", "u", False, 500, "failed", 0)], schema)
    merge = upsert.keep_latest(str(tmp_path / "t"))
    merge(batch, 0)
    version = (tmp_path / "t" / "current").read_text()
    for f in (tmp_path / "t" / version).glob("*.parquet"):
        f.write_bytes(b"broken")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        merge(batch, 1)
    assert (tmp_path / "t" / "current").read_text() == version


def test_windows_of_a_stream_equal_those_of_a_batch(spark, data, tmp_path):
    ev = spark.read.parquet(f"{data}/events.parquet")
    s = spark.readStream.schema(ev.schema).parquet(f"{data}/events.parque[t]")
    q = events.windowed(s).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("windows").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
    assert got.exceptAll(events.windowed(ev)).count() == 0 and got.count() == events.windowed(ev).count()


def test_upsert(spark, tmp_path):
    schema = "record_id bigint, seq bigint, domain string, pdf_url string, ok boolean, http_status int, download_state string, retries int"
    a = spark.createDataFrame([(1, 1, "d", "u", False, 500, "failed", 0), (2, 2, "d", "v", False, 503, "failed", 0)], schema)
    b = spark.createDataFrame([(3, 3, "d", "u", False, None, "failed", 1), (4, 4, "d", "w", False, 403, "blocked", 0)], schema)
    merge = upsert.keep_latest(str(tmp_path / "t"))
    assert upsert.current(spark, str(tmp_path / "t")) is None
    for i, batch in enumerate((a, b, b)):
        merge(batch, i)
    want = latest_retryable(a.unionAll(b))
    assert sorted(tuple(r) for r in upsert.current(spark, str(tmp_path / "t")).select(*want.columns).collect()) == sorted(tuple(r) for r in want.collect()) == [("u", 3, "network", 1), ("v", 2, "server", 0)]


def test_record_reader(spark, tmp_path):
    lines = [json.dumps({"record_id": 1, "ok": True, "metadata": {"title": "T", "authors": ["A"]}}), "", "not json", '["list"]', json.dumps({"record_id": 2}), '{"record_id": 3']
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    df = readers.records(spark, str(tmp_path / "r.jsonl"))
    assert [r.record_id for r in readers.good(df).orderBy("_at").collect()] == [1, 2] and readers.bad_lines(df).collect()[0].lines == 3
    assert [(r.record_id, r.ok) for r in readers.manifest(spark, str(tmp_path / "r.jsonl")).orderBy("_at").collect()] == [(1, True), (2, True)]


def test_other_readers(spark, tmp_path):
    (tmp_path / "reg.csv").write_text("﻿journal_name,host\nA,x\nB,\n", encoding="utf-8")
    assert [tuple(r) for r in readers.registry(spark, str(tmp_path / "reg.csv"), ["journal_name", "host", "url"]).collect()] == [("A", "x", ""), ("B", "", "")]
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    (seeds / "a.json").write_text(json.dumps({"id": "a", "start_urls": ["http://a/v[1-2]", "http://b"], "metadata": {"status": "paused"}}))
    (seeds / "b.json.disabled").write_text("{}")
    assert sorted(tuple(r) for r in readers.seeds(spark, str(seeds)).collect()) == [("a.json", "paused", "http://a/v1"), ("a.json", "paused", "http://a/v2"), ("a.json", "paused", "http://b")]
    side = tmp_path / "side"
    side.mkdir()
    (side / "x.json").write_text('{"notes": {"1": {"text": "t"}}}')
    (side / "y.json").write_text("broken")
    (side / "z.jsonl").write_text('{"type": "footnote", "ordinal": 2}\n{"type": "metadata", "v": 1}\n{"type": "footnote", "ordinal": 1}\n')
    s = readers.sidecars(spark, str(side)).select(F.element_at(F.split("file", "/"), -1).alias("f"), F.try_variant_get("body", "$.notes.1.text", "string").alias("t")).collect()
    assert {(r.f, r.t) for r in s} == {("x.json", "t"), ("y.json", None)}
    z = readers.line_sidecars(spark, str(side)).collect()[0]
    assert json.loads(z.meta)["v"] == 1 and [json.loads(n)["ordinal"] for n in z.notes] == [1, 2]
    (tmp_path / "c.tsv").write_text("path\tpriority\na\t0.5\nb\tx\n")
    assert [r.path for r in readers.candidates(spark, str(tmp_path / "c.tsv"), 0.1).collect()] == ["a"]
    for i in range(6):
        (tmp_path / f"f{i}.pdf").write_bytes(b"%PDF" * (i + 1))
    shards = [readers.files(spark, str(tmp_path), shards=2, shard=k) for k in (0, 1)]
    assert sum(x.count() for x in shards) == 6 and readers.files(spark, str(tmp_path)).agg(F.sum("size")).collect()[0][0] == 84


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", []), (3, "a", None)], "k int, kind string, l array<string>")
    sinks.append_lines(df, str(tmp_path / "j"))
    sinks.append_lines(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 6
    assert sorted(tuple(r) for r in sinks.export(df, str(tmp_path / "e"), "kind").collect()) == [("*", 3), ("a", 2), ("b", 1)]
    sinks.shards(df.repartition(1), str(tmp_path / "s"), rows=2)
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 2
    sinks.joined_csv(df, str(tmp_path / "c"))
    assert {r.l for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()} == {"x|y", None}
    assert [r.k for r in sinks.new_only(df, df.where("k < 3"), "k").collect()] == [3]
    assert "| 1 | a |" in sinks.markdown(df.select("k", "kind").orderBy("k"), "T", 2)
    c = spark.createDataFrame([(i, f"2020-01-0{1 + i // 3} 0{i}:00:00", 10) for i in range(9)], "k int, t string, size int").withColumn("t", F.to_timestamp("t"))
    assert sorted(r.k for r in sinks.within_bytes(c, "size", "t", "k", 50).collect()) == [4, 5, 6, 7, 8]


def test_plugins(spark):
    from corpusloom.sources.plugins import Plugins

    def own(seed, page):
        if "broken" in page:
            raise ValueError
        yield {"page_url": seed, "pdf_url": seed + "own.pdf", "title": "t"}

    pages = spark.createDataFrame([("http://www.a.test/", "<p>"), ("http://a.test/x", "broken"), ("http://b.test/", "<a href='/d.pdf'>D</a><a href='/e'>E</a>"), (None, "x"), ("http://c.test/", None)], "seed_url string, html string")
    p = Plugins().register_many(["www.a.test"], "own", own)
    assert sorted(tuple(r) for r in p.discover(pages).select("pdf_url", "title", "source").collect()) == [("http://b.test/d.pdf", "D", "generic"), ("http://www.a.test/own.pdf", "t", "own")]
    assert Plugins(fallback=None).discover(pages).count() == 0 and p.pick("a.test")[0] == "own" and p.pick("z")[0] == "generic"
