"""Test inputs derived from the given tables, and the tables the jobs build from them.

The stored tables (staging, enriched, pages, ...) are written once per session and data
folder by the same sinks a user would call, into the shared folder, and read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesheet import fixed_values as fv, schemas
from ratesheet.operators import documents, enrichment, paging, retrieval, sensor
from ratesheet.operators.staging import stage_transform
from ratesheet.plans import enrichment_job, sensor_jobs
from ratesheet.session import shared_dir
from ratesheet.sources import messages, sinks, storage, tables
from ratesheet.streaming import arrivals, topics

# One text for both engines; {lineitem}, {part} and {events} name the inputs.
NADAC_RAW_SQL = """
SELECT
 CASE p.p_partkey % 5
   WHEN 0 THEN concat(upper(p.p_name),' ',CAST(p.p_size AS VARCHAR(9)),' MG ',upper(p.p_type))
   WHEN 1 THEN concat(upper(p.p_name),' ',CAST(p.p_size AS VARCHAR(9)),'MG TABLET ',upper(p.p_type))
   WHEN 2 THEN concat(upper(p.p_name),' 0.',CAST(p.p_size AS VARCHAR(9)),'% CREAM')
   WHEN 3 THEN concat('  ',upper(p.p_name),' ',upper(p.p_type),' ')
   ELSE concat(CAST(p.p_size AS VARCHAR(9)),'-',CAST(p.p_size+1 AS VARCHAR(9)),' ',upper(p.p_name)) END AS ndc_description,
 CASE WHEN p.p_partkey % 23 = 0 THEN NULL WHEN p.p_partkey % 23 = 1 THEN ' - '
   ELSE concat(lpad(CAST(p.p_partkey AS VARCHAR(19)),5,'0'),'-',lpad(CAST(p.p_size AS VARCHAR(9)),4,'0'),'-01') END AS ndc,
 concat('$',CAST(CAST(p.p_retailprice + l.l_linenumber AS DECIMAL(12,2)) AS VARCHAR(20))) AS nadac_per_unit,
 CASE l.l_linenumber % 4
   WHEN 0 THEN concat(CAST(month(l.l_shipdate) AS VARCHAR(9)),'/',CAST(day(l.l_shipdate) AS VARCHAR(9)),'/',CAST(year(l.l_shipdate) AS VARCHAR(9)))
   WHEN 1 THEN CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR(10))
   WHEN 2 THEN concat(CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR(10)),'T00:00:00Z')
   ELSE CASE WHEN l.l_orderkey % 7 = 0 THEN 'None' ELSE concat(CAST(year(l.l_shipdate) AS VARCHAR(9)),'/',CAST(month(l.l_shipdate) AS VARCHAR(9)),'/',CAST(day(l.l_shipdate) AS VARCHAR(9))) END END AS effective_date,
 CASE l.l_linestatus WHEN 'O' THEN 'EA' ELSE 'ML' END AS pricing_unit,
 CASE l.l_suppkey % 3 WHEN 0 THEN 'C' WHEN 1 THEN 'I' ELSE 'B' END AS pharmacy_type_indicator,
 CASE WHEN l.l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS otc,
 CASE l.l_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '1, 5' WHEN 2 THEN '2,99' ELSE NULL END AS explanation_code,
 CASE WHEN l.l_returnflag = 'A' THEN 'B' ELSE 'G' END AS classification_for_rate_setting,
 CASE WHEN l.l_returnflag = 'A' THEN CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) AS VARCHAR(20)) END AS corresponding_generic_drug_nadac_per_unit,
 CAST(NULL AS VARCHAR(10)) AS corresponding_generic_drug_effective_date,
 CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR(10)) AS as_of_date
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""

#: What the text above reads of the first input.
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_linestatus", "l_returnflag",
]

SENSOR_RAW_SQL = """
SELECT CAST(user_id AS VARCHAR(19)) AS sensor_id, ts AS reading_ts,
 CASE WHEN event_id % 29 = 0 THEN NULL ELSE value * 0.5 - 60 END AS temperature,
 CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 120 AS DOUBLE) END AS humidity,
 CAST(850 + event_id % 300 AS DOUBLE) AS pressure, event_type AS location FROM {events}
"""

#: Price rows that one task makes.
ROWS_PER_TASK = 250_000
RUN_TS = dt.datetime(2024, 1, 31, 6, 0, 0)
EXTRACTED_AT = dt.datetime(2024, 1, 31, 5, 0, 0)
SENSOR_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_written: dict[tuple[str, str, str], str] = {}
_searchers: dict[str, retrieval.Searcher] = {}
_clocks: dict[tuple[str, str, str], dt.datetime | dt.date] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nadac_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's rows, dealt out: its file may be a single row group, which one task reads, and a
    row becomes ten times as long on the way. The number of tasks follows the number of rows. A row's
    turn is its place in its split, the same again when a lost task is repeated, so nothing is sorted."""
    rows = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    n = max(spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_PER_TASK))
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int")
    dealt = rows.withColumn("_turn", turn).repartitionById(n, F.col("_turn")).drop("_turn")
    return spark.sql(NADAC_RAW_SQL, lineitem=dealt, part=table(spark, sf_dir, "part"))


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SENSOR_RAW_SQL, events=table(spark, sf_dir, "events"))


def run_ts() -> F.Column:
    return F.lit(RUN_TS.isoformat(sep=" ")).cast("timestamp")


def stored(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]
) -> str:
    """Path of a table written once for this session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = shared_dir(spark, name)
        with storage.freed_shuffles(spark):
            write(path)
        _written[key] = path
    return _written[key]


def clock(spark: SparkSession, sf_dir: str, name: str, newest: Callable[[], DataFrame]):
    """The data's own "now": one value, read once."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _clocks:
        _clocks[key] = newest().first()[0]
    return _clocks[key]


# --- price tables ----------------------------------------------------------------------


def staging_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        sinks.write_staging(stage_transform(nadac_raw(spark, sf_dir)), path, "first")

    return stored(spark, sf_dir, "staging", write)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_staging(spark, staging_path(spark, sf_dir))


def enriched_path(spark: SparkSession, sf_dir: str) -> str:
    source = staging_path(spark, sf_dir)
    write = partial(_enrich_by_quarter, spark, source)
    return stored(spark, sf_dir, "enriched", write)


def _enrich_by_quarter(spark: SparkSession, source: str, path: str) -> None:
    enrichment_job.run(spark, source, path, RUN_TS, by="effective_quarter")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.ENRICHED).parquet(enriched_path(spark, sf_dir)).drop("load_id")


def price_as_of(spark: SparkSession, sf_dir: str) -> dt.date:
    return clock(
        spark, sf_dir, "price", lambda: staging(spark, sf_dir).agg(F.max("as_of_date"))
    )


def events_as_of(spark: SparkSession, sf_dir: str) -> dt.datetime:
    return clock(
        spark, sf_dir, "events", lambda: table(spark, sf_dir, "events").agg(F.max("ts"))
    )


# --- pages -----------------------------------------------------------------------------


def _page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted_at = F.lit(EXTRACTED_AT.isoformat(sep=" ")).cast("timestamp_ntz")
    return paging.page_parts(nadac_raw(spark, sf_dir), schemas.STAGING_COLUMNS, extracted_at)


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.with_bodies(_page_parts(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page envelopes, written once, without the bodies that repeat their records."""
    path = stored(
        spark, sf_dir, "envelopes", lambda p: sinks.write_pages(_page_parts(spark, sf_dir), p)
    )
    return paging.with_bodies(spark.read.parquet(path))


def arrived_path(spark: SparkSession, sf_dir: str) -> str:
    """Staging table of the landed page files, filled by the arrival job."""

    def run(path: str) -> None:
        sinks.land_pages(pages(spark, sf_dir), f"{path}/bucket/{fv.RAW_PREFIX}", packed=True)
        places = [f"{path}/{name}" for name in ("staging", "quarantine", "handled", "checkpoint")]
        arrivals.stage_arrivals(spark, f"{path}/bucket", *places).awaitTermination()
        arrivals.archive_handled(spark, f"{path}/bucket", f"{path}/handled", f"{path}/journal")

    return stored(spark, sf_dir, "arrived", run) + "/staging"


def two_loads_path(spark: SparkSession, sf_dir: str) -> str:
    """Enriched table made of two loads of one day, the first of which was run again."""

    def write(path: str) -> None:
        rows = staging(spark, sf_dir)
        first = F.coalesce(F.col("ndc").cast("bigint") % 2 == 0, F.lit(False))
        for load_id, part in (("a", first), ("b", ~first), ("a", first)):
            done = enrichment.enrich(rows.where(part), run_ts())
            sinks.write_enriched(done, path, load_id)

    return stored(spark, sf_dir, "two_loads", write)


def enriched_once_path(spark: SparkSession, sf_dir: str) -> str:
    """Enriched table of three staging loads: the job runs after two, after all, and again."""

    def run(path: str) -> None:
        rows = staging(spark, sf_dir)
        part = F.coalesce(F.pmod(F.col("ndc").cast("bigint"), F.lit(3)), F.lit(0))
        for load, days in (((0, 1), 1), ((2,), 2), ((), 3)):
            for k in load:
                sinks.write_staging(rows.where(part == k), f"{path}/staging", f"part-{k}")
            at = RUN_TS.replace(day=days)
            enrichment_job.run(spark, f"{path}/staging", f"{path}/enriched", at, by="effective_quarter")

    return stored(spark, sf_dir, "enriched_once", run) + "/enriched"


# --- sensors ---------------------------------------------------------------------------

# Messages with fields missing, odd times, and numbers sent as text.
MESSAGES_SQL = """
SELECT event_id, CASE WHEN event_id % 17 > 0 THEN CAST(user_id AS VARCHAR(19)) END AS sensor_id,
 CASE WHEN event_id % 11 = 0 THEN concat('day ', CAST(event_id AS VARCHAR(19)))
   WHEN event_id % 19 > 0 THEN '2024-01-30T10:00:00Z' END AS sent_at,
 CASE WHEN event_id % 29 > 0 THEN CAST(event_id % 400 - 100 AS INTEGER) END AS temperature,
 event_id % 13 = 0 AS is_text FROM {events}
"""


def topic_path(spark: SparkSession, sf_dir: str) -> str:
    """Messages of the events, as lines of base64 text."""

    def land(path: str) -> None:
        sent = spark.sql(MESSAGES_SQL, events=table(spark, sf_dir, "events"))
        fields = ["event_id", "sensor_id", F.col("sent_at").alias("timestamp")]
        number = F.to_json(F.struct(*fields, "temperature"))
        words = F.to_json(F.struct(*fields, F.col("temperature").cast("string").alias("temperature")))
        body = F.when(F.col("is_text"), words).otherwise(number)
        sinks.land_lines(sent.select(messages.encode(body).alias("value")), path)

    return stored(spark, sf_dir, "topic", land)


def routed_path(spark: SparkSession, sf_dir: str) -> str:
    """Topic folders that the routing stream filled: ``valid`` and ``errors``."""
    topic = topic_path(spark, sf_dir)

    def run(path: str) -> None:
        folders = [f"{path}/{name}" for name in ("valid", "errors", "checkpoint")]
        topics.route_messages(spark, topic, *folders).awaitTermination()

    return stored(spark, sf_dir, "routed", run)


def subscribed_path(spark: SparkSession, sf_dir: str) -> str:
    """What two subscribers of the topic, each run twice, have left: ``table`` and ``archive``."""
    topic = topic_path(spark, sf_dir)

    def run(path: str) -> None:
        folders = [f"{path}/{name}" for name in ("table", "errors", "archive", "checkpoint")]
        for _ in range(2):
            for stream in topics.process_and_archive(spark, topic, *folders):
                stream.awaitTermination()

    return stored(spark, sf_dir, "subscribed", run)


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value): notifications made of the events; fields that do not apply are absent."""
    events = table(spark, sf_dir, "events")
    note = F.struct(
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("type"),
        F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("message"),
        F.when(F.col("event_type") == "error", "critical").alias("severity"),
    )
    return events.select("event_id", messages.encode(F.to_json(note)).alias("value"))


def alerts_path(spark: SparkSession, sf_dir: str) -> str:
    """The alert table that the stream fills from the notification topic."""

    def run(path: str) -> None:
        sinks.land_lines(notifications(spark, sf_dir).select("value"), f"{path}/topic")
        folders = [f"{path}/{name}" for name in ("topic", "alerts", "checkpoint")]
        topics.alert_messages(spark, *folders).awaitTermination()

    return stored(spark, sf_dir, "alerts", run) + "/alerts"


def sensor_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings as JSON text, one column ``body``, with the reading they hold."""
    readings = sensor_raw(spark, sf_dir)
    fields = [
        F.date_format("reading_ts", SENSOR_TIME).alias("timestamp") if c == "reading_ts" else c
        for c in readings.columns
    ]
    return readings.withColumn("body", F.to_json(F.struct(*fields)))


def processed_sensor_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        readings = sensor_raw(spark, sf_dir).withColumn("timestamp", F.col("reading_ts").cast("timestamp"))
        rows = sensor.process(readings, run_ts()).select(*schemas.PROCESSED_SENSOR.fieldNames())
        sinks.write_load(rows, path, "first")

    return stored(spark, sf_dir, "processed_sensor", write)


def processed_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_processed_sensor(spark, processed_sensor_path(spark, sf_dir))


def daily_path(spark: SparkSession, sf_dir: str) -> str:
    """Daily metric rows of the last two whole days, the first of which was run again."""
    source, last = processed_sensor_path(spark, sf_dir), events_as_of(spark, sf_dir).date()

    def run(path: str) -> None:
        for back in (1, 2, 1):
            sensor_jobs.summarise_day(spark, source, path, last - dt.timedelta(days=back))

    return stored(spark, sf_dir, "daily", run)


# --- documents and vectors -------------------------------------------------------------


def typed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seventeen typed columns, on price texts cleaned first."""
    return enrichment.typed(enrichment.clean_price_texts(enriched(spark, sf_dir)))


def store_path(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        retrieval.build_store(documents.doc_metadata(typed_prices(spark, sf_dir)), path)

    return stored(spark, sf_dir, "documents", write)


def searcher(spark: SparkSession, sf_dir: str) -> retrieval.Searcher:
    """The searcher over the document store, opened once."""
    path = store_path(spark, sf_dir)
    if path not in _searchers:
        _searchers[path] = retrieval.Searcher(spark, path)
    return _searchers[path]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )


def index_path(spark: SparkSession, sf_dir: str, n_lists: int = 20) -> str:
    def write(path: str) -> None:
        retrieval.build_index(vectors(spark, sf_dir), path, n_lists=n_lists)

    return stored(spark, sf_dir, f"vector_index_{n_lists}", write)


def vector_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored vector asked as a question."""
    return vectors(spark, sf_dir).withColumnRenamed("id", "question_id")
