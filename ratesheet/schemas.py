"""Declared schemas. Nothing in this package infers a schema."""

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DateType(), T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STAGING = _struct(
    ("ndc_description", S),
    ("ndc", S),
    ("nadac_per_unit", S),
    ("effective_date", D),
    ("pricing_unit", S),
    ("pharmacy_type_indicator", S),
    ("otc", S),
    ("explanation_code", S),
    ("classification_for_rate_setting", S),
    ("corresponding_generic_drug_nadac_per_unit", S),
    ("corresponding_generic_drug_effective_date", D),
    ("as_of_date", D),
)
STAGING_COLUMNS = STAGING.fieldNames()
DATE_COLUMNS = [f.name for f in STAGING.fields if f.dataType == D]

# A record as it arrives: the same twelve names, every value still text.
RECORD = _struct(*[(name, S) for name in STAGING_COLUMNS])

DERIVED_COLUMNS = [
    "drug_name",
    "drug_strength",
    "drug_dosage",
    "drug_form",
    "explanation_code_description",
    "enriched_timestamp",
]
ENRICHED = T.StructType(
    STAGING.fields
    + [T.StructField(c, S, True) for c in DERIVED_COLUMNS[:-1]]
    + [T.StructField("enriched_timestamp", T.TimestampType(), True)]
)

# Page files. The payload holders stay maps of raw JSON text, so that "key absent",
# "key null" and "not a list" remain three different things.
PAGE = _struct(
    ("extraction_timestamp", S),
    ("source", S),
    ("api_endpoint", S),
    ("page_number", T.LongType()),
    ("offset", T.LongType()),
    ("limit", T.LongType()),
    ("records_count", T.LongType()),
    ("data", T.MapType(S, S)),
    ("raw_response", T.MapType(S, S)),
    ("results", S),
)

SENSOR = _struct(
    ("sensor_id", S),
    ("timestamp", T.TimestampType()),
    ("temperature", B),
    ("humidity", B),
    ("pressure", B),
    ("location", S),
)

PROCESSED_SENSOR = _struct(
    ("sensor_id", S),
    ("timestamp", T.TimestampType()),
    ("avg_temperature", B),
    ("avg_humidity", B),
    ("avg_pressure", B),
    ("location", S),
    ("quality_score", B),
    ("anomaly_detected", T.BooleanType()),
    ("processing_timestamp", T.TimestampType()),
)

NOTIFICATION = _struct(("type", S), ("message", S), ("severity", S))
