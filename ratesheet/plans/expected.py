"""The same queries in SQL for an independent engine, on views over the given tables."""

from __future__ import annotations

from ratesheet import fixed_values as fv
from ratesheet.operators import retrieval
from ratesheet.plans import catalog as cat
from ratesheet.plans.views import EXTRACTED_AT, MESSAGES_SQL, NADAC_RAW_SQL, RUN_TS, SENSOR_RAW_SQL
from ratesheet.schemas import STAGING_COLUMNS

NL = "chr(10)"
#: How a load that is named after its run time is written.
LOAD_TIME = "%Y%m%dT%H%M%S.%f"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _date(c: str) -> str:
    s = f"trim({c})"
    tries = ", ".join(
        f"CAST(try_strptime({s}, '{f}') AS DATE)" for f in ("%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d")
    )
    return (
        f"CASE WHEN {s} IN ('', 'None', 'null') THEN NULL ELSE coalesce({tries}, "
        f"CASE WHEN substr({s},5,1)='-' AND substr({s},8,1)='-' "
        f"THEN TRY_CAST(substr({s},1,10) AS DATE) END) END"
    )


def _case(c: str, names: dict[str, str], other: str) -> str:
    arms = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in names.items())
    return f"CASE {c} {arms} ELSE {other} END"


CODE_TEXTS = (
    "nullif(array_to_string(list_filter(list_transform(string_split(explanation_code, ','), "
    f"lambda c: {_case('trim(c)', fv.EXPLANATION_CODES, 'NULL')}), lambda t: t IS NOT NULL), "
    f"{_text(fv.EXPLANATION_SEPARATOR)}), '')"
)
NDC = "nullif(regexp_replace(ndc, '[^0-9]', '', 'g'), '')"
STRENGTH = "nullif(regexp_extract(replace({0}, '%', ''), '[0-9]+(\\.[0-9]+)?'), '')"
PRICE = "CAST(regexp_replace(nadac_per_unit, '[^0-9.]', '', 'g') AS DOUBLE)"
WORDS = r"list_filter(string_split_regex(ndc_description, '\s+'), lambda w: w <> '')"

_dates = {"effective_date", "corresponding_generic_drug_effective_date", "as_of_date"}
_staged_columns = ", ".join(
    f"{_date(c)} AS {c}" if c in _dates else f"{NDC} AS ndc" if c == "ndc" else c
    for c in STAGING_COLUMNS
)
_run_ts = f"TIMESTAMP '{RUN_TS}'"

_parsed = rf"""
SELECT *,
 CASE WHEN len(words) = 0 THEN NULL WHEN pos = 0 THEN regexp_replace(ndc_description, '^\s+|\s+$', '', 'g')
   WHEN pos = 1 THEN words[1] ELSE array_to_string(words[1:pos-1], ' ') END AS drug_name,
 CASE WHEN pos > 0 THEN {STRENGTH.format("words[pos]")} END AS drug_strength,
 CASE WHEN pos = 0 THEN NULL WHEN contains(words[pos], '%') THEN words[pos] ELSE words[pos+1] END AS drug_dosage,
 CASE WHEN pos = 0 THEN NULL WHEN contains(words[pos], '%') THEN words[pos+1] ELSE words[pos+2] END AS drug_form
FROM (SELECT *, coalesce(list_position(list_transform(words, lambda w: regexp_matches(w, '[0-9]')), true), 0) AS pos
      FROM (SELECT *, {WORDS} AS words FROM {{source}}))
"""
_legacy = """
SELECT * EXCLUDE (words, n),
 CASE WHEN n >= 4 THEN array_to_string(words[1:n-3], ' ') WHEN n >= 2 THEN words[1] ELSE ndc_description END AS drug_name,
 CASE WHEN n >= 3 THEN TRY_CAST(nullif(regexp_extract(words[n-2], '^([0-9]+)', 1), '') AS INTEGER) END AS drug_strength,
 CASE WHEN n >= 2 THEN words[n-1] END AS drug_dosage,
 words[n] AS drug_form
FROM (SELECT *, len(words) AS n FROM (SELECT *, string_split(ndc_description, ' ') AS words FROM trimmed))
"""

_json = " || ',' || ".join(
    f"'\"{c}\":' || coalesce('\"' || {c} || '\"', 'null')" for c in STAGING_COLUMNS
)
_clean_generic = "regexp_replace(corresponding_generic_drug_nadac_per_unit, '[^0-9.]', '', 'g')"


def _line(label: str, value: str) -> str:
    return f"'{label}' || {value}"


def _money(c: str) -> str:
    return f"'$' || printf('%.2f', {c})"


_document = f"""concat_ws({NL},
 {_line("Drug Name: ", "drug_name")}, {_line("NDC Code: ", "ndc")}, {_line("Strength: ", "drug_strength")},
 {_line("Form: ", "drug_form")}, {_line("Price per Unit: ", _money("nadac_per_unit"))},
 {_line("Pricing Unit: ", "pricing_unit")}, {_line("Effective Date: ", "CAST(effective_date AS VARCHAR)")},
 {_line("Classification: ", _case("classification_for_rate_setting", fv.CLASSIFICATION_NAMES, "classification_for_rate_setting"))},
 {_line("Type: ", f"CASE WHEN otc = 'Y' THEN '{fv.OTC_YES}' WHEN otc IS NOT NULL THEN '{fv.OTC_OTHER}' END")},
 {_line("Available at: ", _case("pharmacy_type_indicator", fv.PHARMACY_NAMES, "pharmacy_type_indicator"))},
 {_line("Explanation Code: ", "explanation_code")}, {_line("Note: ", "explanation_code_description")},
 {_line("Generic Drug Price: ", _money("corresponding_generic_drug_nadac_per_unit"))})"""

_store_columns = ["ndc", "drug_name", "drug_form", "effective_date", "source", "ndc_description", "pricing_unit", "text"]
_store_key = f" || {NL} || ".join(f"coalesce({c}, '')" for c in _store_columns)

# Named parts, each built on the ones before it.
PARTS = {
    "nadac_raw": NADAC_RAW_SQL.format(lineitem="lineitem", part="part"),
    "staged": f"SELECT {_staged_columns} FROM nadac_raw WHERE {NDC} IS NOT NULL",
    "trimmed": "SELECT * REPLACE (trim(ndc_description) AS ndc_description) FROM staged",
    "enriched": f"""SELECT * EXCLUDE (words, pos), {CODE_TEXTS} AS explanation_code_description,
      {_run_ts} AS enriched_timestamp FROM ({_parsed.format(source="trimmed")})""",
    "typed": f"""SELECT ndc, ndc_description, drug_name, drug_strength, drug_dosage, drug_form,
      {PRICE} AS nadac_per_unit, pricing_unit, pharmacy_type_indicator, otc, explanation_code,
      explanation_code_description, classification_for_rate_setting,
      CAST({_clean_generic} AS DOUBLE) AS corresponding_generic_drug_nadac_per_unit,
      corresponding_generic_drug_effective_date, as_of_date, effective_date
      FROM enriched WHERE ndc_description IS NOT NULL AND drug_name IS NOT NULL""",
    "documented": f"""SELECT ndc, drug_name, coalesce(drug_form, '') AS drug_form,
      coalesce(nadac_per_unit, 0.0) AS price, coalesce(CAST(effective_date AS VARCHAR), '') AS effective_date,
      '{fv.DOCUMENT_SOURCE}' AS source, ndc_description, pricing_unit, {_document} AS text FROM typed""",
    "store": f"""SELECT * EXCLUDE (key), key || '-' || lpad(CAST(row_number() OVER (PARTITION BY key ORDER BY price) - 1
      AS VARCHAR), 12, '0') AS doc_id FROM (SELECT *, md5({_store_key}) AS key FROM documented)""",
    "numbered": f"""SELECT *, row_number() OVER (ORDER BY md5(record), record) - 1 AS rn
      FROM (SELECT *, '{{' || {_json} || '}}' AS record FROM nadac_raw)""",
    "paged": f"""SELECT rn // {fv.PAGE_SIZE} + 1 AS page_number, count(*) AS records_count,
      '[' || string_agg(record, ',' ORDER BY rn) || ']' AS records FROM numbered GROUP BY 1""",
    "enveloped": f"""SELECT page_number, (page_number - 1) * {fv.PAGE_SIZE} AS "offset",
      CAST({fv.PAGE_SIZE} AS INTEGER) AS "limit", records_count,
      printf('medicaid_drug_data_page_%04d_', page_number) || '{EXTRACTED_AT:%Y%m%d_%H%M%S}.json' AS file_name,
      '{{"extraction_timestamp":"{EXTRACTED_AT:%Y-%m-%dT%H:%M:%S}","source":"{fv.PAGE_SOURCE}","api_endpoint":"","page_number":'
      || page_number || ',"offset":' || (page_number - 1) * {fv.PAGE_SIZE} || ',"limit":{fv.PAGE_SIZE},"records_count":'
      || records_count || ',"parameters":{{"limit":{fv.PAGE_SIZE},"offset":' || (page_number - 1) * {fv.PAGE_SIZE}
      || '}},"data":{{"results":' || records || '}}}}' AS body FROM paged""",
    "sensor_raw": SENSOR_RAW_SQL.format(events="events"),
    "sent": MESSAGES_SQL.format(events="events"),
    "judged": f"""SELECT *, array_to_string(list_filter([
      CASE WHEN sensor_id IS NULL THEN '{fv.MISSING_FIELD_TEXT}sensor_id' END,
      CASE WHEN sent_at IS NULL THEN '{fv.MISSING_FIELD_TEXT}timestamp' END,
      CASE WHEN temperature IS NULL THEN '{fv.MISSING_FIELD_TEXT}temperature' END,
      CASE WHEN temperature NOT BETWEEN -50 AND 100 THEN '{fv.OUT_OF_RANGE_TEXT}' END],
      lambda e: e IS NOT NULL), '; ') AS errors FROM sent""",
    "processed": f"""SELECT sensor_id, reading_ts, temperature AS avg_temperature, humidity AS avg_humidity,
      pressure AS avg_pressure, location,
      CASE WHEN temperature BETWEEN 0 AND 40 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 900 AND 1100
        THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS quality_score,
      temperature > 35 AS anomaly_detected, {_run_ts} AS processing_timestamp
      FROM sensor_raw WHERE temperature BETWEEN -50 AND 100""",
    "pairwise": """SELECT a.vec_id AS question_id, b.vec_id AS id,
      round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
      FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id""",
    "nearest": f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id
      ORDER BY similarity DESC, id) AS INTEGER) AS rank FROM pairwise) WHERE rank <= {cat.TOP_K}""",
}
_NEEDS = {
    "staged": ["nadac_raw"],
    "trimmed": ["staged"],
    "enriched": ["trimmed"],
    "typed": ["enriched"],
    "documented": ["typed"],
    "store": ["documented"],
    "numbered": ["nadac_raw"],
    "paged": ["numbered"],
    "enveloped": ["paged"],
    "processed": ["sensor_raw"],
    "judged": ["sent"],
    "nearest": ["pairwise"],
}


def _with(sql: str, *names: str, **extra: str) -> str:
    """``sql`` behind the parts it names and those they need."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    ctes = [f"{name} AS ({PARTS[name]})" for name in wanted]
    ctes += [f"{name} AS ({body})" for name, body in extra.items()]
    return f"WITH {', '.join(ctes)} {sql}"


def _search(questions: list[str], k: int, sql: str) -> str:
    """Word-count similarity of documents and questions, then ``sql`` over ``hits``."""

    def buckets(key: str, words: str, source: str) -> str:
        number = f"CAST('0x' || substr(md5(w), 1, 4) AS INTEGER) % {retrieval.DEFAULT_DIM}"
        return (
            f"SELECT {key}, {number} AS b, count(*) AS c FROM (SELECT {key}, "
            f"unnest(regexp_extract_all(lower({words}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}) GROUP BY ALL"
        )

    asked = " UNION ALL ".join(
        f"SELECT {n} AS question_id, {_text(q)} AS question" for n, q in enumerate(questions)
    )
    return _with(
        sql,
        "store",
        asked=asked,
        dw=buckets("doc_id", "text", "store"),
        qw=buckets("question_id", "question", "asked"),
        dn="SELECT doc_id, sqrt(sum(c * c)) AS n FROM dw GROUP BY 1",
        qn="SELECT question_id, sqrt(sum(c * c)) AS n FROM qw GROUP BY 1",
        products="SELECT question_id, doc_id, sum(qw.c * dw.c) AS p FROM qw JOIN dw USING (b) GROUP BY 1, 2",
        scored="""SELECT question_id, doc_id, round(p / (qn.n * dn.n), 6) AS similarity
          FROM products JOIN qn USING (question_id) JOIN dn USING (doc_id)""",
        hits=f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question_id
          ORDER BY similarity DESC, doc_id) AS INTEGER) AS rank FROM scored) JOIN store USING (doc_id)
          WHERE rank <= {k}""",
    )


def _trend(days: int, extra: str = "") -> str:
    return _with(
        f"""SELECT effective_date AS d, round(avg({PRICE}), 6) AS avg_nadac FROM enriched
        WHERE effective_date >= (SELECT max(as_of_date) FROM staged) - INTERVAL {days} DAY {extra} GROUP BY 1""",
        "enriched",
    )


def _enriched(sql: str) -> str:
    return _with(sql, "enriched")


def _raw(sql: str) -> str:
    return _with(sql, "nadac_raw")


_before, _rest = fv.PROMPT_TEMPLATE.split("{context}")
_middle, _after = _rest.split("{question}")
_records = ", ".join(STAGING_COLUMNS)
_day = "(SELECT CAST(max(ts) AS DATE) - 1 FROM events)"
_recent = "(SELECT max(ts) FROM events) - INTERVAL 24 HOUR"
_top_names = """SELECT drug_name, count(*) AS record_count FROM enriched
  WHERE drug_name IS NOT NULL AND drug_name <> '' {0} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""
_avg_price = f"""SELECT drug_name, round(avg({PRICE}), 6) AS avg_price FROM enriched
  WHERE drug_name IS NOT NULL {{0}} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {{1}}"""
_summary = """avg(avg_temperature), max(avg_temperature), min(avg_temperature)"""

_alerts = f"""SELECT event_id, 'NOTIFICATION [' || CASE WHEN event_type = 'error' THEN 'CRITICAL' ELSE 'INFO' END
        || ']: ' || CASE WHEN event_id % 3 <> 0 THEN coalesce(event_type, '{fv.ALERT_TYPE}') ELSE '{fv.ALERT_TYPE}' END
        || ' - ' || CASE WHEN event_id % 5 <> 0 THEN coalesce(props, '{fv.ALERT_MESSAGE}') ELSE '{fv.ALERT_MESSAGE}' END
        AS line FROM events"""

_TYPED: dict[str, str] = {
    "scan_staging": _with("SELECT * FROM staged", "staged"),
    "drop_invalid_ndc": _raw(f"SELECT * REPLACE ({NDC} AS ndc) FROM nadac_raw WHERE {NDC} IS NOT NULL"),
    "ndc_digits": _raw(f"SELECT ndc, {NDC} AS ndc_clean FROM nadac_raw"),
    "ndc_number": _raw(f"SELECT ndc, CAST({NDC} AS BIGINT) AS ndc_value FROM nadac_raw"),
    "ndc_range_bucket": _with(
        "SELECT CAST(ndc AS BIGINT) // 1000000 AS ndc_bucket, count(*) AS n_rows FROM staged GROUP BY 1", "staged"
    ),
    "parse_dates": _raw(f"SELECT effective_date, {_date('effective_date')} AS parsed FROM nadac_raw"),
    "conform_schema": _raw(
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS pricing_unit) FROM nadac_raw"
    ),
    "stage_transform": _with("SELECT * FROM staged", "staged"),
    "stage_metrics": _raw(
        f"""SELECT count(*) AS rows_read, count(*) FILTER ({NDC} IS NULL) AS rows_removed,
        count(*) FILTER ({NDC} IS NOT NULL) AS rows_written FROM nadac_raw"""
    ),
    "price_safe": _raw(
        "SELECT nadac_per_unit, TRY_CAST(regexp_replace(nadac_per_unit, '[$,]', '', 'g') AS DOUBLE) AS price FROM nadac_raw"
    ),
    "tokenize": _raw(
        f"""SELECT ndc_description, CAST(len({WORDS}) AS INTEGER) AS n_tokens,
        array_to_string({WORDS}, '|') AS tokens FROM nadac_raw"""
    ),
    "strength_number": _raw(
        f"""SELECT token, {STRENGTH.format("token")} AS strength, count(*) AS n_rows
        FROM (SELECT unnest({WORDS}) AS token FROM nadac_raw) GROUP BY 1, 2"""
    ),
    "parse_description": _raw(
        f"""SELECT ndc_description, drug_name, drug_strength, drug_dosage, drug_form
        FROM ({_parsed.format(source="nadac_raw")})"""
    ),
    "explain_codes": _raw(
        f"SELECT explanation_code, {CODE_TEXTS} AS explanation_code_description FROM nadac_raw"
    ),
    "explain_codes_join": _raw(
        f"""SELECT explanation_code, {CODE_TEXTS} AS explanation_code_description,
        count(*) AS n_rows FROM nadac_raw GROUP BY 1, 2"""
    ),
    "decode_flags": _raw(
        f"""SELECT classification_for_rate_setting, pharmacy_type_indicator, otc,
        {_case("classification_for_rate_setting", fv.CLASSIFICATION_NAMES, "classification_for_rate_setting")} AS classification_text,
        {_case("pharmacy_type_indicator", fv.PHARMACY_NAMES, "pharmacy_type_indicator")} AS pharmacy_text,
        CASE WHEN otc = 'Y' THEN '{fv.OTC_YES}' WHEN otc IS NOT NULL THEN '{fv.OTC_OTHER}' END AS otc_text FROM nadac_raw"""
    ),
    "enrich": _enriched("SELECT * FROM enriched"),
    "enrich_legacy": _with(
        f"""SELECT *, {CODE_TEXTS} AS explanation_code_description,
        {_run_ts} AS enriched_timestamp FROM ({_legacy})""",
        "trimmed",
    ),
    "load_enriched": _enriched(
        "SELECT * FROM enriched WHERE ndc_description IS NOT NULL AND drug_name IS NOT NULL"
    ),
    "limited_rows": _enriched(
        " UNION ALL ".join(
            f"""SELECT CAST({n} AS INTEGER) AS row_limit, least({n}, count(*)) AS n_rows FROM enriched
            WHERE ndc_description IS NOT NULL AND drug_name IS NOT NULL"""
            for n in cat.ROW_LIMITS
        )
    ),
    "load_typed": _with("SELECT * FROM typed", "typed"),
    "top_drugs": _enriched(_top_names.format("")),
    "top_drugs_by_form": _enriched(_top_names.format(f"AND drug_form = '{cat.LOOKUP_FORM}'")),
    "form_distribution": _enriched(
        """SELECT bucket AS drug_form, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
          SELECT CASE WHEN rn <= 10 THEN drug_form ELSE 'Other' END AS bucket, cnt FROM (
            SELECT drug_form, cnt, row_number() OVER (ORDER BY cnt DESC, drug_form) AS rn FROM (
              SELECT drug_form, count(*) AS cnt FROM enriched
              WHERE drug_form IS NOT NULL AND drug_form <> '' GROUP BY 1))) GROUP BY 1"""
    ),
    "form_value_counts": _enriched(
        """SELECT drug_form, count(*) AS n_rows FROM enriched WHERE drug_form IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
    ),
    "price_trend": _trend(90),
    "trend_by_ndc": _trend(
        cat.TREND_DAYS,
        """AND ndc = (SELECT ndc FROM enriched WHERE effective_date IS NOT NULL
        ORDER BY effective_date DESC, ndc DESC LIMIT 1)""",
    ),
    "strength_vs_price": _enriched(
        f"""SELECT TRY_CAST(drug_strength AS DOUBLE) AS strength_val, {PRICE} AS nadac_value, drug_form, drug_name
        FROM enriched WHERE drug_strength IS NOT NULL AND nadac_per_unit IS NOT NULL
        ORDER BY drug_name NULLS FIRST, 1 NULLS FIRST, 2 NULLS FIRST, drug_form NULLS FIRST LIMIT 2000"""
    ),
    "avg_price_by_drug": _enriched(_avg_price.format("", 20)),
    "latest_rows": _enriched(
        f"""SELECT * EXCLUDE (enriched_timestamp) FROM enriched ORDER BY as_of_date DESC,
        {", ".join(c + " NULLS FIRST" for c in STAGING_COLUMNS if c != "as_of_date")}, drug_name LIMIT 10"""
    ),
    "drug_lookup": _enriched(
        f"""SELECT ndc, drug_name, drug_form, nadac_per_unit, effective_date FROM enriched
        WHERE drug_name LIKE '%{cat.LOOKUP_NAME}%' AND drug_form = '{cat.LOOKUP_FORM}'"""
    ),
    "partition_filter": _enriched(
        _avg_price.format(
            f"AND year(effective_date) || 'Q' || quarter(effective_date) = '{cat.QUARTER}'", 100
        )
    ),
    "data_summary": _enriched(
        f"""SELECT count(*) AS n_rows, count(DISTINCT drug_name) AS n_drugs, count(DISTINCT ndc) AS n_ndcs,
        min({PRICE}) AS min_price, max({PRICE}) AS max_price FROM enriched"""
    ),
    "retention_filter": _with(
        f"""SELECT as_of_date, count(*) AS n_rows FROM staged WHERE as_of_date >=
        (SELECT max(as_of_date) FROM staged) - INTERVAL {fv.RAW_RETENTION_DAYS} DAY GROUP BY 1""",
        "staged",
    ),
    "drug_document": _with(f"SELECT ndc, {_document} AS document FROM typed", "typed"),
    "rich_description": _enriched(
        f"""SELECT ndc, concat_ws('. ', {_line("Drug: ", "ndc_description")}, {_line("Name: ", "drug_name")},
        {_line("Strength: ", "drug_strength")}, {_line("Dosage: ", "drug_dosage")}, {_line("Form: ", "drug_form")},
        'Price: $' || nadac_per_unit || ' per ' || coalesce(pricing_unit, 'None')) || '.' AS document FROM enriched"""
    ),
    "doc_metadata": _with(
        "SELECT ndc, drug_name, drug_form, price, effective_date, source FROM documented", "documented"
    ),
    "doc_preview": _with(
        'SELECT ndc, substr(text, 1, 200) AS short, substr(text, 1, 500) AS "long" FROM documented', "documented"
    ),
    "page_envelopes": _with(
        """SELECT page_number, "offset", "limit", records_count, file_name,
        CAST(strlen(body) AS INTEGER) AS file_size_bytes, md5(body) AS body_md5 FROM enveloped""",
        "enveloped",
    ),
    "page_totals": _with(
        """SELECT count(*) AS total_files_created, CAST(sum(records_count) AS BIGINT) AS total_records,
        max(page_number) AS pages_processed FROM paged""",
        "paged",
    ),
    "archive_path": _with(
        f"""SELECT '{fv.RAW_PREFIX}' || file_name AS object_name,
        '{fv.PROCESSED_PREFIX}' || file_name AS archived_name FROM enveloped""",
        "enveloped",
    ),
    "read_pages": _with(
        f"""SELECT page_number, "offset", records_count, '{fv.PAGE_SOURCE}' AS source,
        records_count AS n_records FROM enveloped""",
        "enveloped",
    ),
    "extract_records": _with(
        f"SELECT {_records} FROM numbered WHERE (rn // {fv.PAGE_SIZE} + 1) % 5 IN (0, 1, 2)", "numbered"
    ),
    "locate_records": _with(
        f"""SELECT rn // {fv.PAGE_SIZE} + 1 AS page_number, {_records} FROM numbered
        WHERE (rn // {fv.PAGE_SIZE} + 1) % 7 < 5""",
        "numbered",
    ),
    "scan_sensor": _with("SELECT * FROM sensor_raw", "sensor_raw"),
    "scan_processed_sensor": _with(
        'SELECT * EXCLUDE (reading_ts), reading_ts AS "timestamp" FROM processed', "processed"
    ),
    "sensor_clean": _with("SELECT * FROM sensor_raw WHERE temperature BETWEEN -50 AND 100", "sensor_raw"),
    "sensor_process": _with("SELECT * FROM processed", "processed"),
    "sensor_daily": _with(
        f"""SELECT location AS subcategory, {_day} AS "date", '{fv.METRIC_NAME}' AS metric_name,
        round(avg(avg_temperature), 6) AS metric_value, '{fv.METRIC_CATEGORY}' AS category,
        round(avg(avg_temperature), 6) AS daily_avg_temperature, max(avg_temperature) AS daily_max_temperature,
        min(avg_temperature) AS daily_min_temperature, round(avg(avg_humidity), 6) AS daily_avg_humidity,
        round(avg(avg_pressure), 6) AS daily_avg_pressure, count(*) FILTER (anomaly_detected) AS anomaly_count,
        count(*) AS total_readings FROM processed WHERE CAST(reading_ts AS DATE) = {_day} GROUP BY location""",
        "processed",
    ),
    "validate_records": _with(
        f"""SELECT sensor_id, reading_ts, errors = '' AS is_valid, errors FROM (SELECT sensor_id, reading_ts,
        concat_ws('; ', CASE WHEN sensor_id IS NULL THEN '{fv.MISSING_FIELD_TEXT}sensor_id' END,
          CASE WHEN reading_ts IS NULL THEN '{fv.MISSING_FIELD_TEXT}timestamp' END,
          CASE WHEN temperature IS NULL THEN '{fv.MISSING_FIELD_TEXT}temperature' END,
          CASE WHEN temperature < -50 OR temperature > 100 THEN '{fv.OUT_OF_RANGE_TEXT}' END) AS errors
        FROM sensor_raw)""",
        "sensor_raw",
    ),
    "decode_message": _with("SELECT * FROM sensor_raw", "sensor_raw"),
    "sensor_message_row": _with(
        f"""SELECT sensor_id, reading_ts, temperature AS avg_temperature, humidity AS avg_humidity,
        pressure AS avg_pressure, location, 0.95::DOUBLE AS quality_score, false AS anomaly_detected,
        {_run_ts} AS processing_timestamp FROM sensor_raw""",
        "sensor_raw",
    ),
    "two_loads": _with("SELECT drug_name, count(*) AS n_rows FROM enriched WHERE ndc_description IS NOT NULL AND drug_name IS NOT NULL GROUP BY 1", "enriched"),
    "enriched_once": _with(
        f"""SELECT CASE part WHEN 2 THEN '{RUN_TS.replace(day=2):{LOAD_TIME}}' ELSE '{RUN_TS.replace(day=1):{LOAD_TIME}}' END AS load_id,
        CAST(CASE part WHEN 2 THEN 1 ELSE 2 END AS BIGINT) AS n_sources, drug_name, drug_form, count(*) AS n_rows,
        count(DISTINCT ndc) AS n_ndc FROM (SELECT *, coalesce(CAST(ndc AS BIGINT) % 3, 0) AS part FROM enriched)
        GROUP BY 1, 2, 3, 4""",
        "enriched",
    ),
    "arrived_records": _with("SELECT * FROM staged", "staged"),
    "routed_messages": _with(
        "SELECT event_id, sensor_id, sent_at, CAST(temperature AS DOUBLE) AS temperature FROM judged WHERE errors = ''",
        "judged",
    ),
    "error_payloads": _with("SELECT event_id, sensor_id, errors, sent_at FROM judged WHERE errors <> ''", "judged"),
    "alert_lines": _alerts,
    "alert_stream": f"SELECT line, count(*) AS n FROM ({_alerts}) GROUP BY line",
    "processed_messages": _with(
        """SELECT sensor_id, CAST(temperature AS DOUBLE) AS avg_temperature, 0.95::DOUBLE AS quality_score,
        false AS anomaly_detected, coalesce(sent_at NOT LIKE 'day%', false) AS has_time, true AS is_stamped FROM sent""",
        "sent",
    ),
    "archived_messages": _with("SELECT event_id, sensor_id, true AS is_stamped FROM sent", "sent"),
    "daily_metrics": _with(
        f"""SELECT strftime(day, '%Y-%m-%d') AS "date", location AS subcategory, '{fv.METRIC_NAME}' AS metric_name,
        round(avg(avg_temperature), 6) AS metric_value, '{fv.METRIC_CATEGORY}' AS category,
        round(avg(avg_temperature), 6) AS daily_avg_temperature, round(max(avg_temperature), 6) AS daily_max_temperature,
        round(min(avg_temperature), 6) AS daily_min_temperature, round(avg(avg_humidity), 6) AS daily_avg_humidity,
        round(avg(avg_pressure), 6) AS daily_avg_pressure,
        CAST(count(*) FILTER (anomaly_detected) AS DOUBLE) AS anomaly_count, CAST(count(*) AS DOUBLE) AS total_readings
        FROM (SELECT *, CAST(reading_ts AS DATE) AS day FROM processed)
        WHERE day IN ({_day}, {_day} - INTERVAL 1 DAY) GROUP BY day, location""",
        "processed",
    ),
    "quarantine": _with(
        """SELECT pressure % 7 = 0 AS is_broken, sensor_id,
        CASE WHEN pressure % 7 <> 0 THEN location END AS location FROM sensor_raw""",
        "sensor_raw",
    ),
    "freshness": _with(
        f"""SELECT 'staging' AS table_name, max(ts) AS latest, count(*) AS n_rows, count(*) = 0 AS is_stale
        FROM events WHERE ts >= {_recent} UNION ALL
        SELECT 'final', max(reading_ts), count(*), count(*) = 0 FROM processed WHERE reading_ts >= {_recent}""",
        "processed",
    ),
    "error_rate": f"""SELECT status, n_rows, percentage, status = 'error' AND percentage > 10 AS is_alert FROM (
        SELECT event_type AS status, count(*) AS n_rows,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percentage
        FROM events WHERE ts >= {_recent} GROUP BY 1)""",
    "null_violations": _with(
        """SELECT table_name, n AS violations, n = 0 AS passed FROM (
        SELECT 'staging' AS table_name, count(*) FILTER (props IS NULL OR ts IS NULL) AS n FROM events UNION ALL
        SELECT 'final', count(*) FILTER (temperature IS NULL OR reading_ts IS NULL) FROM sensor_raw)""",
        "sensor_raw",
    ),
    "query_log_summary": """SELECT count(*) AS n_queries, round(avg(value), 6) AS avg_seconds,
        round(avg(length(props)), 6) AS avg_answer_chars, round(avg(user_id), 6) AS avg_sources FROM events""",
    "cosine_pairs": """SELECT a.vec_id AS id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
        CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "topk_search": _search(
        [cat.SOURCE_QUESTION],
        cat.TOP_K,
        """SELECT question_id, rank, ndc, ndc_description, drug_name, price AS nadac_per_unit, pricing_unit,
        similarity AS similarity_score FROM hits""",
    ),
    "batch_topk": _with("SELECT * FROM nearest", "nearest"),
    "clustered_topk": _with("SELECT * FROM nearest", "nearest"),
    "table_search": _search(
        cat.QUESTIONS, cat.TOP_K, "SELECT question_id, rank, ndc, price, similarity FROM hits"
    ),
    "index_recall": f"""SELECT {cat.N_PROBE} AS n_probe, CAST({cat.TOP_K} * count(*) AS BIGINT) AS n_true,
        true AS recall_reached FROM embeddings""",
    "recall_at_k": _with(
        f"""SELECT CAST({cat.TOP_K} AS INTEGER) AS k, count(*) AS n_questions, round(avg(share), 6) AS recall FROM (
        SELECT question_id, count(*) FILTER (a.label = b.label) / {cat.TOP_K}.0::DOUBLE AS share
        FROM nearest JOIN embeddings a ON a.vec_id = question_id JOIN embeddings b ON b.vec_id = id GROUP BY 1)""",
        "nearest",
    ),
    "criteria_search": _search(
        [retrieval.criteria_text(**cat.CRITERIA)],
        cat.CRITERIA_K,
        f"""SELECT rank, ndc, drug_name, drug_form, price, effective_date, similarity FROM hits
        WHERE price >= {cat.CRITERIA["min_price"]}""",
    ),
    "prompt_context": _search(
        cat.QUESTIONS,
        cat.TOP_K,
        f"""SELECT question_id, question, count(*) AS num_sources, {_text(_before)}
        || string_agg(text, {NL} || {NL} ORDER BY rank) || {_text(_middle)} || question || {_text(_after)} AS prompt
        FROM hits JOIN asked USING (question_id) GROUP BY 1, 2""",
    ),
    "conversation_context": f"""WITH said AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
        SELECT a.conv_id, a.turn, a.role, a.text, CAST(count(b.turn) AS INTEGER) AS n_context_turns,
        coalesce(string_agg(b.role || ': ' || b.text, {NL} ORDER BY b.turn, b.role || ': ' || b.text), '') AS context
        FROM said a LEFT JOIN said b ON b.conv_id = a.conv_id AND b.turn < a.turn GROUP BY ALL""",
}


def _as_text(name: str, sql: str) -> str:
    columns = cat.TEXT_OUTPUT.get(name)
    if not columns:
        return sql
    texts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({texts}) FROM ({sql})"


EXPECTED: dict[str, str] = {name: _as_text(name, sql) for name, sql in _TYPED.items()}
