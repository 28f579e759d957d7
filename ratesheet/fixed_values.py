"""Fixed values.

Texts, codes, formats and thresholds that results must carry exactly. They are
data, not logic, and are kept here in one place.
"""

import datetime as dt

# Explanation code -> text. Codes 7 to 10 share one text.
EXPLANATION_CODES = {
    "1": "Calculated from most recent pharmacy survey",
    "2": "Average acquisition cost within ±2% of current NADAC; carried forward",
    "3": "Survey NADAC adjusted due to pricing changes or help desk inquiry",
    "4": "NADAC carried forward from previous file",
    "5": "NADAC calculated based on package size",
    "6": "CMS S/I/N designation modified per State Medicaid reimbursement practices",
    "7": "Reserved",
    "8": "Reserved",
    "9": "Reserved",
    "10": "Reserved",
}
EXPLANATION_SEPARATOR = " | "

# Display texts of the coded columns.
CLASSIFICATION_NAMES = {"B": "Brand Name", "G": "Generic"}
PHARMACY_NAMES = {
    "C": "Community pharmacy",
    "I": "Institutional pharmacy",
    "B": "Both community and institutional",
}
OTC_YES, OTC_OTHER = "Over-the-counter", "Prescription"

# The first and last day that counts as a date, and the page file format.
DATE_RANGE = (dt.date(1677, 9, 22), dt.date(2262, 4, 11))
PAGE_SIZE = 5000
PAGE_FILE_FORMAT = "medicaid_drug_data_page_%04d_%s.json"
PAGE_FILE_TIME = "yyyyMMdd_HHmmss"
PAGE_SOURCE = "medicaid_drug_data"
RAW_PREFIX = "drug_data/raw/"
PROCESSED_PREFIX = "drug_data/processed/"

# Keys under which an API reply may hold its records.
REPLY_KEYS = ("results", "data", "records")
REPLY_FALLBACK_KEYS = ("items", "rows", "entries", "content")

# Sensor rules.
TEMPERATURE_RANGE = (-50, 100)
GOOD_TEMPERATURE, GOOD_HUMIDITY, GOOD_PRESSURE = (0, 40), (0, 100), (900, 1100)
GOOD_SCORE, POOR_SCORE, MESSAGE_SCORE = 1.0, 0.8, 0.95
ANOMALY_ABOVE = 35
REQUIRED_FIELDS = ("sensor_id", "timestamp", "temperature")
MISSING_FIELD_TEXT = "Missing required field: "
OUT_OF_RANGE_TEXT = "Temperature out of valid range (-50 to 100)"
# Measures of the daily summary: name, how, of which column.
DAILY_MEASURES = [
    ("daily_avg_temperature", "avg", "avg_temperature"),
    ("daily_max_temperature", "max", "avg_temperature"),
    ("daily_min_temperature", "min", "avg_temperature"),
    ("daily_avg_humidity", "avg", "avg_humidity"),
    ("daily_avg_pressure", "avg", "avg_pressure"),
    ("anomaly_count", "count_if", "anomaly_detected"),
    ("total_readings", "count", "*"),
]
METRIC_NAME, METRIC_CATEGORY = "daily_sensor_summary", "sensors"
ALERT_FORMAT = "NOTIFICATION [%s]: %s - %s"
ALERT_TYPE, ALERT_MESSAGE, ALERT_SEVERITY = "general", "No message provided", "info"

# Monitoring limits.
ERROR_STATUS, ERROR_LIMIT_PERCENT = "error", 10
FRESH_HOURS = 24
STAGING_EXPIRY_SECONDS, RAW_RETENTION_DAYS = 7200, 30

# Retrieval texts.
DOCUMENT_SOURCE = "medicaid_enriched_data"
EMPTY_CRITERIA = "all drugs"
CONTEXT_SEPARATOR = "\n\n"
PROMPT_TEMPLATE = """You are a helpful assistant that answers questions about Medicaid drug pricing and information.

Use the following pieces of context from the Medicaid enriched drug database to answer the question.
If you don't know the answer based on the context provided, say "I don't have enough information to answer that question."
Always cite specific drug names, NDC codes, and prices when available.

Context:
{context}

Question: {question}

Answer (be specific and include relevant details like drug name, form, strength, and pricing):"""
