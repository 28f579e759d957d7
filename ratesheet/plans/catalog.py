"""Registry of the checked queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads whole tables. Averages are rounded so that two engines agree.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratesheet import fixed_values as fv, schemas
from ratesheet.functions import text, values, vectors as vec
from ratesheet.operators import (
    conversation,
    documents,
    enrichment,
    paging,
    quality,
    reports,
    retrieval,
    sensor,
    staging,
)
from ratesheet.plans import views
from ratesheet.sources import messages, pages, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the parameterised queries.
LOOKUP_NAME, LOOKUP_FORM = "RING", "CREAM"
TREND_DAYS = 365
QUARTER = "1998Q2"
TOP_K = 5
CRITERIA = {"drug_form": "CREAM 0.7%", "min_price": 905.0}
CRITERIA_K = 25
ROW_LIMITS = 100, 1_000_000_000
#: Lists that the approximate search reads, of twenty. The given vectors hardly cluster: with 8 lists the
#: measured recall is 0.74 to 0.76, with 13 0.89 to 0.92, with 15 0.94 to 0.95.
N_PROBE = 15
SOURCE_QUESTION = "hot gear, counted in ml"
QUESTIONS = [
    "list every old bolt with a strength of 12 MG",
    "plate, new",
    "blue anvil near nine hundred",
    "entries last priced in 1996 that carry code 99",
    "gizmo gizmo gizmo",
    "anything large for an unknown pharmacy",
    "small ring 7 brand",
]

# Columns handed out as text: dates and nullable integers, which table libraries represent
# differently from engine to engine.
_DATES = schemas.DATE_COLUMNS
TEXT_OUTPUT = {
    "scan_staging": _DATES,
    "arrived_records": _DATES,
    "ndc_number": ["ndc_value"],
    "parse_dates": ["parsed"],
    "stage_transform": _DATES,
    "enrich": _DATES,
    "enrich_legacy": [*_DATES, "drug_strength"],
    "load_enriched": _DATES,
    "load_typed": _DATES,
    "price_trend": ["d"],
    "trend_by_ndc": ["d"],
    "latest_rows": _DATES,
    "drug_lookup": ["effective_date"],
    "retention_filter": ["as_of_date"],
    "sensor_daily": ["date"],
}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name."""
    text_columns = TEXT_OUTPUT.get(fn.__name__, [])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in text_columns})

    QUERIES[fn.__name__] = run
    return fn


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the other engine returns them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _midnight(day: dt.date) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day)


# --- staging ---------------------------------------------------------------------------


@query
def scan_staging(spark, sf):
    return views.staging(spark, sf)


@query
def drop_invalid_ndc(spark, sf):
    return staging.drop_invalid_ndc(views.nadac_raw(spark, sf))


@query
def ndc_digits(spark, sf):
    return views.nadac_raw(spark, sf).select(
        "ndc", values.ndc_digits(F.col("ndc")).alias("ndc_clean")
    )


@query
def ndc_number(spark, sf):
    return views.nadac_raw(spark, sf).select(
        "ndc", values.ndc_number(F.col("ndc")).alias("ndc_value")
    )


@query
def ndc_range_bucket(spark, sf):
    return staging.ndc_bucket_counts(staging.drop_invalid_ndc(views.nadac_raw(spark, sf)))


@query
def parse_dates(spark, sf):
    return views.nadac_raw(spark, sf).select(
        "effective_date", values.parse_date(F.col("effective_date")).alias("parsed")
    )


@query
def conform_schema(spark, sf):
    """A frame with one column missing and one too many, conformed."""
    raw = views.nadac_raw(spark, sf).drop("pricing_unit").withColumn("extra", F.lit(1))
    return staging.conform(raw)


@query
def stage_transform(spark, sf):
    return staging.stage_transform(views.nadac_raw(spark, sf))


@query
def stage_metrics(spark, sf):
    return staging.stage_metrics(views.nadac_raw(spark, sf))


@query
def price_safe(spark, sf):
    return views.nadac_raw(spark, sf).select(
        "nadac_per_unit", values.price_safe(F.col("nadac_per_unit")).alias("price")
    )


# --- descriptions and codes ------------------------------------------------------------


@query
def tokenize(spark, sf):
    words = text.tokens(F.col("ndc_description"))
    return views.nadac_raw(spark, sf).select(
        "ndc_description",
        F.size(words).alias("n_tokens"),
        F.array_join(words, "|").alias("tokens"),
    )


@query
def strength_number(spark, sf):
    words = views.nadac_raw(spark, sf).select(
        F.explode(text.tokens(F.col("ndc_description"))).alias("token")
    )
    return (
        words.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select("token", text.strength_number(F.col("token")).alias("strength"), "n_rows")
    )


@query
def parse_description(spark, sf):
    return enrichment.parse_descriptions(views.nadac_raw(spark, sf).select("ndc_description"))


@query
def explain_codes(spark, sf):
    return views.nadac_raw(spark, sf).select(
        "explanation_code",
        text.explain_codes(F.col("explanation_code")).alias("explanation_code_description"),
    )


@query
def explain_codes_join(spark, sf):
    return enrichment.explain_codes_join(views.nadac_raw(spark, sf))


@query
def decode_flags(spark, sf):
    columns = ["classification_for_rate_setting", "pharmacy_type_indicator", "otc"]
    return enrichment.decode_flags(views.nadac_raw(spark, sf).select(*columns))


@query
def enrich(spark, sf):
    staged = staging.stage_transform(views.nadac_raw(spark, sf))
    return _naive(enrichment.enrich(staged, views.run_ts()), "enriched_timestamp")


@query
def enrich_legacy(spark, sf):
    staged = staging.stage_transform(views.nadac_raw(spark, sf))
    return _naive(enrichment.enrich_legacy(staged, views.run_ts()), "enriched_timestamp")


# --- enriched table --------------------------------------------------------------------


@query
def load_enriched(spark, sf):
    rows = tables.read_enriched(spark, views.enriched_path(spark, sf))
    return _naive(rows, "enriched_timestamp").drop("effective_quarter")


@query
def load_typed(spark, sf):
    return views.typed_prices(spark, sf)


@query
def top_drugs(spark, sf):
    return reports.top_drugs(views.enriched(spark, sf))


@query
def top_drugs_by_form(spark, sf):
    return reports.top_drugs(views.enriched(spark, sf), form=LOOKUP_FORM)


@query
def form_distribution(spark, sf):
    return reports.form_distribution(views.enriched(spark, sf))


@query
def form_value_counts(spark, sf):
    return reports.form_value_counts(views.enriched(spark, sf))


@query
def price_trend(spark, sf):
    as_of = views.price_as_of(spark, sf)
    return _rounded(reports.price_trend(views.enriched(spark, sf), as_of), "avg_nadac")


@query
def trend_by_ndc(spark, sf):
    """Trend of the product that was priced last."""
    rows = views.enriched(spark, sf)
    as_of = views.price_as_of(spark, sf)
    newest = rows.agg(F.max(F.struct("effective_date", "ndc"))["ndc"]).first()[0]
    return _rounded(reports.price_trend(rows, as_of, TREND_DAYS, newest), "avg_nadac")


@query
def strength_vs_price(spark, sf):
    return reports.strength_vs_price(views.enriched(spark, sf))


@query
def avg_price_by_drug(spark, sf):
    return reports.avg_price_by_drug(views.enriched(spark, sf))


@query
def latest_rows(spark, sf):
    rows = views.enriched(spark, sf).drop("effective_quarter", "enriched_timestamp")
    return reports.latest_rows(rows, "as_of_date")


@query
def drug_lookup(spark, sf):
    rows = reports.drug_lookup(views.enriched(spark, sf), LOOKUP_NAME, LOOKUP_FORM)
    return rows.select("ndc", "drug_name", "drug_form", "nadac_per_unit", "effective_date")


@query
def partition_filter(spark, sf):
    return reports.avg_price_in_quarter(views.enriched(spark, sf), QUARTER)


@query
def data_summary(spark, sf):
    return reports.data_summary(views.enriched(spark, sf))


@query
def retention_filter(spark, sf):
    """Rows of the last thirty days, counted per day."""
    as_of = _midnight(views.price_as_of(spark, sf))
    kept = quality.retain(
        views.staging(spark, sf), "as_of_date", as_of, dt.timedelta(days=fv.RAW_RETENTION_DAYS)
    )
    return kept.groupBy("as_of_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def enriched_once(spark, sf):
    """Rows of three staging loads after three runs of the enrichment job, and its ledger."""
    path = views.enriched_once_path(spark, sf)
    made = sinks.ledger(spark, path).groupBy("load_id").agg(F.count("source").alias("n_sources"))
    rows = spark.read.parquet(path).join(F.broadcast(made), "load_id")
    return rows.groupBy("load_id", "n_sources", "drug_name", "drug_form").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("ndc").alias("n_ndc")
    )


@query
def limited_rows(spark, sf):
    """How many rows a read with a limit hands out, for limits below and above the table's size."""
    path = views.enriched_path(spark, sf)
    counts = [
        tables.read_enriched(spark, path, limit=n).agg(F.lit(n).alias("row_limit"), F.count(F.lit(1)).alias("n_rows"))
        for n in ROW_LIMITS
    ]
    return counts[0].unionByName(counts[1])


@query
def two_loads(spark, sf):
    """Rows per name of a table that two loads of one day, one of them repeated, have filled."""
    rows = tables.read_enriched(spark, views.two_loads_path(spark, sf))
    return rows.groupBy("drug_name").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def arrived_records(spark, sf):
    """Page files landed, picked up by the arrival job, staged and archived."""
    return tables.read_staging(spark, views.arrived_path(spark, sf))


# --- documents -------------------------------------------------------------------------


@query
def drug_document(spark, sf):
    rows = views.typed_prices(spark, sf)
    return rows.select("ndc", documents.drug_document(rows).alias("document"))


@query
def rich_description(spark, sf):
    return views.enriched(spark, sf).select("ndc", documents.rich_description().alias("document"))


@query
def doc_metadata(spark, sf):
    rows = documents.doc_metadata(views.typed_prices(spark, sf))
    return rows.select("ndc", "drug_name", "drug_form", "price", "effective_date", "source")


@query
def doc_preview(spark, sf):
    rows = views.typed_prices(spark, sf)
    document = documents.drug_document(rows)
    return rows.select(
        "ndc",
        text.preview(document, 200).alias("short"),
        text.preview(document, 500).alias("long"),
    )


# --- pages -----------------------------------------------------------------------------


@query
def page_envelopes(spark, sf):
    return views.envelopes(spark, sf).select(
        "page_number", "offset", "limit", "records_count", "file_name", "file_size_bytes",
        F.md5("body").alias("body_md5"),
    )


@query
def page_totals(spark, sf):
    return paging.page_totals(views.pages(spark, sf))


@query
def archive_path(spark, sf):
    raw = F.concat(F.lit(fv.RAW_PREFIX), "file_name")
    return views.pages(spark, sf).select(
        raw.alias("object_name"), values.archive_path(raw).alias("archived_name")
    )


@query
def read_pages(spark, sf):
    """Page files landed one by one and read back whole."""
    path = views.stored(
        spark, sf, "page_files", lambda p: sinks.land_pages(views.pages(spark, sf), p, packed=True)
    )
    landed = pages.read_pages(spark, path)
    found = pages.records_text(F.col("data"), F.col("raw_response"), F.col("results"))
    return landed.select(
        (F.col("offset") / F.col("limit") + 1).cast("bigint").alias("page_number"),
        "offset",
        "records_count",
        "source",
        F.size(F.from_json(found, pages.RECORDS)).cast("bigint").alias("n_records"),
    )


def _shapes(spark, sf, shapes):
    """Pages rewritten into the given payload shapes, landed one page a line."""
    rows = views.pages(spark, sf).withColumn("n", F.col("page_number") % len(shapes))
    body = F.lit(None).cast("string")
    for n, shape in enumerate(shapes):
        before, after = shape.split("@")
        body = F.when(F.col("n") == n, F.concat(F.lit(before), "records", F.lit(after))).otherwise(
            body
        )
    return rows.select("page_number", body.alias("body"))


@query
def extract_records(spark, sf):
    """All payload shapes of a page file; the last two yield no record."""
    shapes = [
        '{"page_number":1,"data":{"results":@}}',
        '{"raw_response":{"results":@}}',
        '{"data":{"results":null},"results":@}',
        '{"data":{"count":2},"raw_response":{"results":@}}',
        '{"data":@}',
    ]

    def land(path):
        sinks.land_page_lines(_shapes(spark, sf, shapes), path, packed=True)

    path = views.stored(spark, sf, "shaped_pages", land)
    return pages.extract_records(pages.read_pages(spark, path, whole_file=False))


@query
def locate_records(spark, sf):
    """All shapes of an API reply; the last two yield no record."""
    shapes = [
        "@",
        '{"results":@}',
        '{"data":@,"items":[]}',
        '{"results":[],"entries":[],"content":@}',
        '{"results":null,"data":[],"rows":@}',
        '{"results":[],"data":@}',
        '{"data":{"results":@},"items":[]}',
    ]
    return pages.locate_records(_shapes(spark, sf, shapes), "body", "page_number")


# --- sensors ---------------------------------------------------------------------------


@query
def scan_sensor(spark, sf):
    def land(path):
        sinks.land_lines(views.sensor_json(spark, sf).select("body"), path)

    path = views.stored(spark, sf, "sensor_json", land)
    rows = tables.read_sensor(spark, f"{path}/*.txt", whole_file=False)
    return _naive(rows, "timestamp").withColumnRenamed("timestamp", "reading_ts")


@query
def scan_processed_sensor(spark, sf):
    return _naive(views.processed_sensor(spark, sf), "timestamp", "processing_timestamp")


@query
def sensor_clean(spark, sf):
    return sensor.clean(views.sensor_raw(spark, sf))


@query
def sensor_process(spark, sf):
    rows = sensor.process(views.sensor_raw(spark, sf), views.run_ts())
    return _naive(rows, "processing_timestamp")


@query
def sensor_daily(spark, sf):
    """Yesterday's readings per location."""
    yesterday = views.events_as_of(spark, sf).date() - dt.timedelta(days=1)
    rows = sensor.process(views.sensor_raw(spark, sf), views.run_ts())
    summary = sensor.daily_summary(rows, yesterday, "reading_ts")
    metrics = sensor.metric_rows(summary, *sensor.SUMMARY_COLUMNS).drop("metadata")
    averages = [c for c in sensor.SUMMARY_COLUMNS if "avg" in c]
    return _rounded(metrics, "metric_value", *averages)


@query
def validate_records(spark, sf):
    rows = sensor.validate(views.sensor_raw(spark, sf), time_col="reading_ts")
    return rows.select(
        "sensor_id", "reading_ts", "is_valid", F.array_join("errors", "; ").alias("errors")
    )


@query
def decode_message(spark, sf):
    encoded = views.sensor_json(spark, sf).select(messages.encode(F.col("body")).alias("value"))
    rows = _naive(messages.decode_readings(encoded), "timestamp")
    return rows.select(
        "sensor_id",
        F.col("timestamp").alias("reading_ts"),
        *["temperature", "humidity", "pressure", "location"],
    )


@query
def sensor_message_row(spark, sf):
    rows = sensor.message_rows(views.sensor_raw(spark, sf), views.run_ts())
    return _naive(rows, "processing_timestamp")


@query
def alert_lines(spark, sf):
    """A line for each notification."""
    encoded = views.notifications(spark, sf)
    return sensor.alert_lines(messages.decode_notifications(encoded)).select("event_id", "line")


@query
def quarantine(spark, sf):
    """Sensor lines, some cut short, read in permissive mode."""
    body = F.when(F.col("pressure") % 7 == 0, F.expr("substring(body, 1, length(body) - 3)"))
    lines = views.sensor_json(spark, sf).select(F.coalesce(body, "body").alias("body"))
    path = views.stored(spark, sf, "broken_lines", lambda p: sinks.land_lines(lines, p))
    rows = tables.read_or_quarantine(spark, path, schemas.SENSOR)
    broken = F.col(tables.CORRUPT).isNotNull()
    return rows.select(
        broken.alias("is_broken"),
        F.when(broken, F.get_json_object(F.concat(F.col(tables.CORRUPT), F.lit('"}')), "$.sensor_id"))
        .otherwise(F.col("sensor_id"))
        .alias("sensor_id"),
        F.when(~broken, F.col("location")).alias("location"),
    )


@query
def routed_messages(spark, sf):
    """Messages that the routing stream found valid."""
    lines = spark.read.text(f"{views.routed_path(spark, sf)}/valid").select("value")
    rows = messages.decode_readings(lines)
    event = F.get_json_object("body", "$.event_id").cast("bigint").alias("event_id")
    sent_at = F.get_json_object("body", "$.timestamp").alias("sent_at")
    return rows.select(event, "sensor_id", sent_at, "temperature")


@query
def error_payloads(spark, sf):
    """Payloads of the messages that the routing stream rejected."""
    lines = spark.read.text(f"{views.routed_path(spark, sf)}/errors")
    at = lambda path: F.get_json_object("value", path)
    return lines.select(
        at("$.original_data.event_id").cast("bigint").alias("event_id"),
        at("$.original_data.sensor_id").alias("sensor_id"),
        F.array_join(F.from_json(at("$.errors"), "array<string>"), "; ").alias("errors"),
        at("$.timestamp").alias("sent_at"),
    )


@query
def processed_messages(spark, sf):
    """Rows that the processing subscriber of the topic has added."""
    rows = tables.read_processed_sensor(spark, f"{views.subscribed_path(spark, sf)}/table")
    return rows.select(
        "sensor_id", "avg_temperature", "quality_score", "anomaly_detected",
        F.col("timestamp").isNotNull().alias("has_time"), F.col("processing_timestamp").isNotNull().alias("is_stamped"),
    )


@query
def archived_messages(spark, sf):
    """Messages that the other subscriber has archived, as they were sent."""
    rows = spark.read.parquet(f"{views.subscribed_path(spark, sf)}/archive")
    body = messages.message_text(F.col("value"))
    return rows.select(
        F.get_json_object(body, "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object(body, "$.sensor_id").alias("sensor_id"),
        F.col("received_at").isNotNull().alias("is_stamped"),
    )


@query
def alert_stream(spark, sf):
    """The alert table by line."""
    rows = spark.read.parquet(views.alerts_path(spark, sf))
    return rows.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query
def daily_metrics(spark, sf):
    """The daily table, its JSON detail taken apart again."""
    rows = spark.read.parquet(views.daily_path(spark, sf))
    detail = F.from_json("metadata", ", ".join(f"{c} double" for c in sensor.SUMMARY_COLUMNS))
    parts = [F.round(F.col("detail")[c], 6).alias(c) for c in sensor.SUMMARY_COLUMNS]
    value = F.round("metric_value", 6).alias("metric_value")
    return rows.withColumn("detail", detail).select(
        F.col("date").cast("string").alias("date"), "metric_name", value, "category", "subcategory", *parts
    )


# --- monitoring ------------------------------------------------------------------------


@query
def freshness(spark, sf):
    as_of = views.events_as_of(spark, sf)
    events = views.table(spark, sf, "events")
    processed = sensor.process(views.sensor_raw(spark, sf))
    return quality.freshness(events, "ts", as_of, "staging").unionByName(
        quality.freshness(processed, "reading_ts", as_of, "final")
    )


@query
def error_rate(spark, sf):
    events = views.table(spark, sf, "events")
    return quality.error_rate(events, "event_type", "ts", views.events_as_of(spark, sf))


@query
def null_violations(spark, sf):
    raw = views.sensor_raw(spark, sf)
    return quality.null_violations(
        views.table(spark, sf, "events"), ["props", "ts"], "staging"
    ).unionByName(quality.null_violations(raw, ["temperature", "reading_ts"], "final"))


@query
def query_log_summary(spark, sf):
    summary = quality.query_log_summary(
        views.table(spark, sf, "events"), F.col("value"), F.col("props"), F.col("user_id")
    )
    return _rounded(summary, "avg_seconds", "avg_answer_chars", "avg_sources")


# --- retrieval -------------------------------------------------------------------------


@query
def cosine_pairs(spark, sf):
    """Each stored vector with the next one."""
    a = views.vectors(spark, sf)
    b = a.select((F.col("id") - 1).alias("id"), F.col("vector").alias("other"))
    similarity = vec.cosine(F.col("vector"), F.col("other"))
    return a.join(b, "id").select("id", F.round(similarity, 6).alias("similarity"))


@query
def topk_search(spark, sf):
    """One question in words against the document store, as source records."""
    return retrieval.sources(views.searcher(spark, sf).ask([SOURCE_QUESTION], TOP_K))


@query
def batch_topk(spark, sf):
    """Every stored vector against all others."""
    return retrieval.topk(
        views.vectors(spark, sf), views.vector_questions(spark, sf), TOP_K, skip_self=True
    )


@query
def clustered_topk(spark, sf):
    """The same answer through the clustered index."""
    path, asked = views.index_path(spark, sf), views.vector_questions(spark, sf)
    return retrieval.search_index(spark, path, asked, TOP_K, skip_self=True)


@query
def table_search(spark, sf):
    """The questions as a table, against the same documents."""
    asked = retrieval.question_table(spark, QUESTIONS)
    hits = retrieval.search(retrieval.load_store(spark, views.store_path(spark, sf)), asked, TOP_K)
    return hits.select("question_id", "rank", "ndc", "price", "similarity")


@query
def index_recall(spark, sf):
    """Whether a search of ``N_PROBE`` lists finds at least nine tenths of the true hits."""
    path, asked = views.index_path(spark, sf), views.vector_questions(spark, sf)
    close = retrieval.search_index(spark, path, asked, TOP_K, N_PROBE, skip_self=True)
    true = batch_topk(spark, sf).select("question_id", "id", F.lit(1).alias("found"))
    both = true.join(close.select("question_id", "id", F.lit(1).alias("close")), ["question_id", "id"], "left")
    return both.agg(
        F.lit(N_PROBE).alias("n_probe"),
        F.sum("found").alias("n_true"),
        (F.count("close") >= 0.9 * F.sum("found")).alias("recall_reached"),
    )


@query
def recall_at_k(spark, sf):
    labels = views.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return retrieval.recall_at_k(batch_topk(spark, sf), labels, TOP_K)


@query
def criteria_search(spark, sf):
    """Criteria turned into a question; the price bound applies to what came back."""
    hits = views.searcher(spark, sf).ask([retrieval.criteria_text(**CRITERIA)], CRITERIA_K)
    kept = retrieval.within_price(hits, None, CRITERIA["min_price"])
    return kept.select(
        "rank", "ndc", "drug_name", "drug_form", "price", "effective_date", "similarity"
    )


@query
def prompt_context(spark, sf):
    asked = retrieval.question_table(spark, QUESTIONS)
    return retrieval.prompts(views.searcher(spark, sf).ask(QUESTIONS, TOP_K), asked)


@query
def conversation_context(spark, sf):
    return conversation.conversation_context(views.table(spark, sf, "conversations"))
