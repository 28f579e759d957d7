"""Sinks, layouts, the enrichment job, sensors, monitoring."""

import datetime as dt
import glob
import json
import re
import os
import time

import pytest
from pyspark.sql import DataFrame, Observation, functions as F

from ratesheet import schemas
from ratesheet.operators import enrichment, quality, reports, sensor
from ratesheet.operators.staging import stage_transform
from ratesheet.plans import enrichment_job, retention_job, sensor_jobs, views
from ratesheet.session import shared_dir
from ratesheet.sources import ranges, sinks, tables


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    return stage_transform(views.nadac_raw(spark, sf_dir)).persist()


def test_staging_layout(spark, staged, tmp_path):
    path = str(tmp_path / "staging")
    sinks.write_staging(staged, path, "one", n=4)
    stored = tables.read_staging(spark, path)
    assert stored.schema == schemas.STAGING
    assert stored.exceptAll(staged).count() == 0 and stored.count() == staged.count()
    low_high = [
        spark.read.parquet(f).agg(F.min(F.col("ndc").cast("long")), F.max(F.col("ndc").cast("long"))).first()
        for f in sorted(glob.glob(f"{path}/load_id=one/*.parquet"))
    ]
    assert all(a[1] // 10**6 <= b[0] // 10**6 for a, b in zip(low_high, low_high[1:]))


def test_enrichment_job_is_repeatable(spark, staged, tmp_path):
    source, target = str(tmp_path / "staging"), str(tmp_path / "enriched")
    sinks.write_staging(staged, source, "one")
    n = staged.count()
    for day, written, total in ((1, n, n), (1, 0, n), (2, 0, n), (2, 7, n + 7)):
        if written == 7:
            sinks.write_staging(staged.limit(7), source, "two")
        counts = enrichment_job.run(spark, source, target, dt.datetime(2024, 1, day, 6))
        assert counts == {"rows_written": written}
        assert spark.read.parquet(target).count() == total
    days = {p.rsplit("=", 1)[1] for p in glob.glob(f"{target}/load_id=*/enriched_date=*")}
    held = {(r.source.rsplit("=", 1)[1], r.load_id) for r in sinks.ledger(spark, target).collect()}
    assert held == {("one", "20240101T060000.000000"), ("two", "20240102T060000.000000")}
    assert days == {"2024-01-01", "2024-01-02"}
    stored = tables.read_enriched(spark, target, limit=7)
    assert stored.count() == 7
    assert stored.columns[: len(schemas.ENRICHED)] == schemas.ENRICHED.fieldNames()


def test_equal_rows_spread_over_tasks(spark, staged, tmp_path):
    """A third of all rows being one row does not make one file of them."""
    n = staged.count() // 2
    copies = F.explode(F.sequence(F.lit(1), F.lit(n)))
    hot = staged.limit(1).withColumn("n", copies).drop("n").repartition(8)
    path = str(tmp_path / "hot")
    sinks.write_staging(staged.unionByName(hot), path, "one", n=8)
    ndc = hot.first().ndc
    sizes = [spark.read.parquet(f).where(F.col("ndc") == ndc).count() for f in glob.glob(f"{path}/*/*.parquet")]
    assert sum(sizes) >= n and max(sizes) < 0.7 * n


def test_filters_reach_the_scan(spark, staged, tmp_path):
    path = str(tmp_path / "enriched")
    run_ts = F.lit("2024-01-31 06:00:00").cast("timestamp")
    sinks.write_enriched(enrichment.enrich(staged, run_ts), path, "one", by="effective_quarter")
    rows = spark.read.parquet(path)
    trend = reports.price_trend(rows, dt.date(2001, 12, 1), 90)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(effective_date,2001-09-02)" in plan
    assert "effective_quarter" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<nadac_per_unit:string,effective_date:date>" in plan
    top = reports.top_drugs(rows)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<drug_name:string>" in top and "Not(EqualTo(drug_name,))" in top


def test_form_distribution_keeps_a_real_other(spark):
    forms = ["F%02d" % i for i in range(14) for _ in range(14 - i)] + ["Other"] * 20 + [None, ""]
    df = spark.createDataFrame([(f,) for f in forms], "drug_form string")
    got = {r.drug_form: r.cnt for r in reports.form_distribution(df).collect()}
    # The ten largest keep their name ("Other" is one of them); five small ones join it.
    assert len(got) == 10 and got["F00"] == 14
    assert got["Other"] == 20 + sum(14 - i for i in range(9, 14))


READINGS = [
    ["north-7", "2023-11-05T00:00:00Z", -3.25, 88.0, 990.5, "roof"],
    ["north-8", "2023-11-05T08:30:00Z", 41.75, 12.5, 1001.0, "kiln"],
    ["north-9", "2023-11-05T23:59:59Z", 8.25, None, 987.5, "roof"],
    ["south-1", "2023-11-06T00:00:00Z", None, None, None, None],
    ["south-2", "2023-11-06T10:00:00Z", 150.0, 40.0, 1000.0, "roof"],
]
FIELDS = ["sensor_id", "timestamp", "temperature", "humidity", "pressure", "location"]
SAMPLE = [{k: v for k, v in zip(FIELDS, r) if v is not None} for r in READINGS]


def test_loads_add_and_repeat(spark, staged, tmp_path):
    """Two loads of one day both stay, in either layout; a repeated load counts once."""
    first, second = staged.limit(10), staged.limit(3)
    at = dt.datetime(2024, 3, 1, 6)
    for by in ("enriched_date", "effective_quarter"):
        target = str(tmp_path / by)
        for load_id, rows in (("a", first), ("b", second), ("a", first)):
            source = str(tmp_path / f"staging-{by}-{load_id}")
            sinks.write_staging(rows, source, "only")
            enrichment_job.run(spark, source, target, at, by=by, load_id=load_id)
        assert spark.read.parquet(target).count() == 13
        assert spark.read.parquet(target).groupBy("load_id").count().count() == 2


def test_retention(spark, staged, tmp_path):
    table, enriched = str(tmp_path / "staging"), str(tmp_path / "enriched")
    for day, load_id in enumerate(("old", "older", "new"), 1):
        sinks.write_staging(staged.limit(5), table, load_id)
        if load_id != "older":
            enrichment_job.run(spark, table, enriched, dt.datetime(2024, 5, day))
    for load_id in ("old", "older"):
        os.utime(f"{table}/load_id={load_id}", (0, 0))
    sinks.write_staging(staged.limit(2), table, "late")
    os.utime(f"{table}/load_id=late", (0, 0))
    # All but the late one are enriched; of these, two are old.
    assert retention_job.expire_loads(spark, table, time.time(), enriched=enriched) == 2
    assert tables.read_staging(spark, table).count() == 7
    assert retention_job.expire_loads(spark, table, time.time()) == 1
    assert tables.read_staging(spark, table).count() == 5
    assert spark.read.parquet(enriched).count() == 15
    assert retention_job.drop_days(spark, enriched, dt.date(2024, 5, 3)) == 1
    assert spark.read.parquet(enriched).count() == 10


def test_a_broken_run_leaves_nothing(spark, staged, tmp_path, monkeypatch):
    """Rows and ledger come with one move: without it neither is there, and the next run does all."""
    source, target = str(tmp_path / "staging"), str(tmp_path / "enriched")
    sinks.write_staging(staged.limit(9), source, "one")

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(sinks.storage, "publish", broken)
        with pytest.raises(OSError):
            enrichment_job.run(spark, source, target, dt.datetime(2024, 5, 1))
    assert sinks.ledger(spark, target).count() == 0 and not glob.glob(f"{target}/load_id=*")
    assert enrichment_job.run(spark, source, target, dt.datetime(2024, 5, 2)) == {"rows_written": 9}
    assert spark.read.parquet(target).count() == 9 and sinks.ledger(spark, target).count() == 1


def test_sketches_place_rows_without_a_sample(spark, staged, tmp_path, monkeypatch):
    """The enriched load is dealt by the staging sketches: ranges of names, and no row lost."""
    source, target = str(tmp_path / "staging"), str(tmp_path / "enriched")
    sinks.write_staging(staged, source, "one", n=4)
    monkeypatch.setattr(DataFrame, "repartitionByRange", None)  # that one would sample
    rows = enrichment.enrich(tables.read_staging(spark, source))
    load = f"{source}/load_id=one"
    limits = ranges.bounds(spark, [load], "name", 6)
    assert len(limits) == 5 and limits == sorted(limits)
    dealt = ranges.deal(rows, ranges.sort_number(F.lit(0), F.ltrim("ndc_description")), limits)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "passthrough" in plan.lower() and "rangepartitioning" not in plan
    sinks.write_enriched(rows, target, "a", n=6, sources=[load])
    assert spark.read.parquet(target).count() == staged.count()
    spans = []
    for f in glob.glob(f"{target}/load_id=a/enriched_date=*/*.parquet"):
        part = spark.read.parquet(f)
        low, high, n = part.agg(F.min("drug_name"), F.max("drug_name"), F.count(F.lit(1))).first()
        assert n < 0.5 * staged.count()
        spans.append((low or "", high or ""))
    spans.sort()
    assert len(spans) == 6
    assert all(a[1][:6] <= b[0][:6] or a[1].startswith(b[0][:6]) for a, b in zip(spans, spans[1:]))
    # The second staging load is placed by the first one's sketch.
    sinks.write_staging(staged, source, "two", n=4)
    codes = [
        spark.read.parquet(f).agg(F.min(F.col("ndc").cast("long")), F.max(F.col("ndc").cast("long"))).first()
        for f in sorted(glob.glob(f"{source}/load_id=two/*.parquet"))
    ]
    assert len(codes) == 4 and all(a[1] // 10**6 <= b[0] // 10**6 for a, b in zip(codes, codes[1:]))


def test_a_first_load_is_made_once(spark, tmp_path, monkeypatch):
    """Without sketches the bounds come from a pass that makes the sort number alone."""
    monkeypatch.setattr(DataFrame, "repartitionByRange", None)  # that one would make all columns twice
    made = spark.sparkContext.accumulator(0)

    def seen(text):
        made.add(1)
        return text

    names = [f"{'abcdefgh'[k % 8]} drug {k}" for k in range(400)]
    rows = [(n, str(10**6 * (k % 40) + 7), None) for k, n in enumerate(names)] + [(None, "7", None)] * 3
    df = spark.createDataFrame(rows, "ndc_description string, ndc string, nadac_per_unit string").repartition(3)
    staged = stage_transform(df.withColumn("otc", F.udf(seen)("ndc_description")))
    path, target = str(tmp_path / "staging"), str(tmp_path / "enriched")
    sinks.write_staging(staged, path, "one", n=5)
    stored = tables.read_staging(spark, path)
    assert made.value == 403
    assert stored.exceptAll(staged).count() == 0 and stored.count() == 403
    files = [spark.read.parquet(f).agg(F.count(F.lit(1)), F.min(F.col("ndc").cast("long")), F.max(F.col("ndc").cast("long"))).first()
             for f in sorted(glob.glob(f"{path}/load_id=one/*.parquet"))]
    assert len(files) == 5 and all(a[2] <= b[1] for a, b in zip(files, files[1:]))
    assert all(60 <= f[0] <= 100 for f in files)
    sinks.write_enriched(enrichment.enrich(stored), target, "a", n=4)  # no staging load named
    assert spark.read.parquet(target).count() == 403
    assert len(glob.glob(f"{target}/load_id=a/enriched_date=*/*.parquet")) == 4
    sinks.write_enriched(enrichment.enrich(stored), target, "b")  # few rows, one range
    assert len(glob.glob(f"{target}/load_id=b/enriched_date=*/*.parquet")) == 1


def test_measured_bounds(spark):
    number = F.col("id")
    limits = ranges.measured(spark.range(1000), number, 4)
    assert len(limits) == 3 and all(abs(a - b) < 20 for a, b in zip(limits, (250, 500, 750)))
    assert len(ranges.measured(spark.range(1000), number, 100, least=250)) == 3
    assert ranges.measured(spark.range(1000), number, 8, least=1000) is None
    assert ranges.measured(spark.range(0), number, 4) is None and ranges.measured(spark.range(9), number, 1) is None


def test_dealing_stays_compiled(spark, sf_dir):
    """No method of a staging write grows with the ranges over the 8,000 bytes that the JVM compiles."""
    placed = stage_transform(views.nadac_raw(spark, sf_dir)).withColumn("ndc_bucket", F.col("ndc").try_cast("bigint"))
    by_code = ranges.sort_number(F.col("ndc_bucket"), F.col("ndc_description"), text_bytes=5)
    dealt = ranges.deal(placed, by_code, [k << 40 for k in range(1, 1000)])
    modes = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        text = dealt._jdf.queryExecution().explainString(modes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_raw_rows_are_dealt_without_a_sort(spark, tmp_path):
    """A row's turn is its place in its split: even shares, the same each time, and no row sorted for it."""
    n = 4000
    lines = spark.range(n, numPartitions=1).selectExpr(
        "1 l_orderkey", "1L l_partkey", "1 l_suppkey", "1 l_linenumber", "date'2024-01-31' l_shipdate",
        "'O' l_linestatus", "'R' l_returnflag",
    )
    parts = spark.sql("SELECT 1L p_partkey, 'ring' p_name, 7 p_size, 'tin' p_type, 2.5D p_retailprice")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    raw = views.nadac_raw(spark, str(tmp_path))
    assert "RoundRobin" not in raw._jdf.queryExecution().executedPlan().toString()
    shares = raw.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    assert [r.n for r in shares.collect()] == [n / spark.sparkContext.defaultParallelism] * spark.sparkContext.defaultParallelism


def test_sort_numbers_are_columns_when_sketched(spark):
    """A number that stands inside a sketch is interpreted for each row; as a column it is compiled."""
    rows = spark.createDataFrame([(k, None if k % 7 == 0 else f" name {k:03}") for k in range(100)], "k long, t string")
    numbers = {"k": F.col("k"), "t": ranges.sort_number(F.lit(0), F.ltrim("t"))}
    sketches = Observation("test")
    seen = ranges.observed(rows, numbers, sketches)
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    (line,) = [text for text in plan.splitlines() if "CollectMetrics" in text]
    assert "conv(" not in line and "conv(" in plan
    assert sorted(seen.collect()) == sorted(rows.collect()) and seen.columns == rows.columns
    for name, number in numbers.items():
        plain = rows.agg(F.kll_sketch_to_string_bigint(F.kll_sketch_agg_bigint(number))).first()[0]
        got = spark.createDataFrame([(bytes(sketches.get[name]),)], "s binary")
        assert got.select(F.kll_sketch_to_string_bigint("s")).first()[0] == plain


def test_a_hot_value_gets_several_ranges(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(1500)).alias("x"))
    limits = [250, 500, 750, 1500, 1500, 1500, 2250]
    got = ranges.deal(rows.repartition(6), F.col("x"), limits).withColumn("p", F.spark_partition_id())
    parts = {r.p: (r.n, r.low, r.high) for r in got.groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    assert sum(n for n, _, _ in parts.values()) == 3000
    for p, (n, low, high) in parts.items():
        assert all(b <= low for b in limits[: min(p, 3)]) and n < 1200, (p, n, low, high)
    hot = {p: n for p, (n, low, high) in parts.items() if low == 1500 == high}
    assert len(hot) >= 2


def test_sensor_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "sample.json").write_text(json.dumps(SAMPLE, indent=2))
    for _ in range(2):
        counts = sensor_jobs.process(spark, f"{tmp_path}/in/*.json", f"{tmp_path}/out", "monday")
        assert counts == {"rows_read": 5, "rows_written": 3}
        stored = tables.read_processed_sensor(spark, f"{tmp_path}/out")
        got = {r.sensor_id: (r.quality_score, r.anomaly_detected) for r in stored.collect()}
        assert got == {"north-7": (0.8, False), "north-8": (0.8, True), "north-9": (0.8, False)}
    for _ in range(2):
        sensor_jobs.summarise_day(spark, f"{tmp_path}/out", f"{tmp_path}/daily", dt.date(2023, 11, 5))
        rows = spark.read.parquet(f"{tmp_path}/daily").orderBy("subcategory").collect()
        assert [(r.subcategory, r.metric_value) for r in rows] == [("kiln", 41.75), ("roof", 2.5)]
    assert json.loads(rows[1].metadata) == {
        "daily_avg_temperature": 2.5, "daily_max_temperature": 8.25, "daily_min_temperature": -3.25,
        "daily_avg_humidity": 88.0, "daily_avg_pressure": 989.0, "anomaly_count": 0, "total_readings": 2,
    }


def test_validation_and_payload(spark):
    df = spark.createDataFrame(
        [("s1", None, 150.0), ("s2", "t", 20.0)], "sensor_id string, timestamp string, temperature double"
    )
    checked = sensor.validate(df)
    payload = json.loads(sensor.error_payloads(checked, F.lit("x"), F.lit("5")).first().value)
    assert payload == {
        "original_data": "x",
        "errors": ["Missing required field: timestamp", "Temperature out of valid range (-50 to 100)"],
        "timestamp": 5,
    }


def test_quarantine_keeps_the_text(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"sensor_id":"a","temperature":1.5}\n{"sensor_id":"b"\nno json\n')
    df = tables.read_or_quarantine(spark, f"{tmp_path}/l.json", schemas.SENSOR)
    for _ in range(2):
        sinks.write_or_quarantine(df, f"{tmp_path}/good", f"{tmp_path}/bad", "one")
    assert [r.sensor_id for r in spark.read.parquet(f"{tmp_path}/good").collect()] == ["a"]
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/bad").collect()) == ["no json", '{"sensor_id":"b"']


def test_monitoring(spark):
    now = dt.datetime(2024, 1, 2, 12)
    rows = [("ok", now - dt.timedelta(hours=h)) for h in range(40)] + [("error", now)] * 3
    df = spark.createDataFrame(rows, "status string, at timestamp_ntz")
    got = {r.status: (r.n_rows, r.percentage, r.is_alert) for r in quality.error_rate(df, "status", "at", now).collect()}
    assert got == {"ok": (25, 89.285714, False), "error": (3, 10.714286, True)}
    late = now + dt.timedelta(days=3)
    assert tuple(quality.freshness(df, "at", late, "t").first()) == ("t", None, 0, True)
    assert quality.retain(df, "at", now, dt.timedelta(seconds=7200)).count() == 6
    assert quality.null_violations(df, ["status", "at"], "t").first().passed


class Session:
    """Stands in for a session with the given settings."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: conf.get(key, default))})


def test_shared_dir_follows_the_session():
    named = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert shared_dir(named, "x").startswith("hdfs://shared/ratesheet/")
    assert shared_dir(Session("local[2]")).startswith("/tmp/run-")
    with pytest.raises(ValueError):
        shared_dir(Session("yarn"))


def test_ranges_follow_the_rows(spark, staged, tmp_path, monkeypatch):
    """The rows that one task sorts are bounded, however few splits the packed files make."""
    source, asked, write = str(tmp_path / "staging"), [], sinks.write_enriched
    sinks.write_staging(staged.limit(60).coalesce(1), source, "one", n=1)
    monkeypatch.setattr(enrichment_job, "ROWS_PER_RANGE", 4)
    monkeypatch.setattr(sinks, "write_enriched", lambda *a, **b: (asked.append(b["n"]), write(*a, **b)))
    done = enrichment_job.run(spark, source, str(tmp_path / "enriched"), dt.datetime(2024, 5, 1))
    assert done == {"rows_written": 60} and asked == [15]
