"""Schemas and fixed values of the two log formats.

Everything in the block marked FIXED VALUES must stay as it is: the parsers,
the lateness rules and the document ids depend on these exact values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- FIXED VALUES
# Text layout of every timestamp in both log formats (parse and format).
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
# Strict shape of a timestamp text; lenient forms such as 2019-1-1 1:1:1 are rejected.
TIME_REGEX = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
# Watermark: max event time seen minus this bound; the max starts at 0.
OUT_OF_ORDERNESS_MS = 10_000
# A window stays open for refinements this long after its end.
ALLOWED_LATENESS_MS = 30_000
# Tumbling window sizes of the report job (canonical) and of its second variant.
REPORT_WINDOW_MS = 30 * 60 * 1000
SHORT_WINDOW_MS = 30 * 1000
# Keys the cleaner writes into every item (existing values are overwritten).
ITEM_AREA_KEY = "area"
ITEM_DT_KEY = "dt"
# Separator of the country list in an area-mapping row, e.g. "FR,DE,IT".
COUNTRY_SEPARATOR = ","
# Field separator of a late-row text line: "<epoch ms>\t<type>\t<area>".
LATE_LINE_SEPARATOR = "\t"
# Java string concatenation prints a null reference as this text.
NULL_TEXT = "null"
# Search document id: time (blank replaced by "_") - type - area.
DOC_ID_BLANK = " "
DOC_ID_BLANK_REPLACEMENT = "_"
DOC_ID_SEPARATOR = "-"
# Prefix of an area name in the mapping, e.g. AREA_ASIA.
AREA_PREFIX = "AREA_"
# ------------------------------------------------------------ end FIXED VALUES

# Raw nested log: {"dt":..., "countryCode":..., "data":[{...}, ...]}.
# Items keep every key (open schema), so they are MAP<STRING, VARIANT>.
CORRUPT_COLUMN = "_corrupt_record"
RAW_LOG_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.StringType()),
        T.StructField("countryCode", T.StringType()),
        T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.VariantType()))),
        T.StructField(CORRUPT_COLUMN, T.StringType()),
    ]
)

# Audit log: {"dt":..., "type":..., "username":..., "area":...}.
AUDIT_LOG_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

AUDIT_PARSE_SCHEMA = T.StructType([*AUDIT_LOG_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])

# Text records as a message source delivers them (key may be null).
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
