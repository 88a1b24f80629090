"""Column names, types and fixed domain values.

Raw service-order exports come as two tables: order *headers* (one row per
repair) and order *positions* (parts and labour lines).  Their original
column names collide case-insensitively (``artikel`` vs ``ARTIKEL``), which
Spark cannot hold in one plan, so every column gets an English name at ingest.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the original tool's for identical results.
# ---------------------------------------------------------------------------

# Raw header columns, in source spelling, mapped to our names.
HEADER_SOURCE_COLUMNS = {
    "serviceauftrag": "order_id",
    "adresse": "address_code",
    "artikel": "product_article",
    "typ": "product_type",
    "datum_waein": "d_goods_in",
    "datum_repstart": "d_repair_start",
    "datum_repkv": "d_repair_quote",
    "datum_kv": "d_quote",
    "datum_auftrag": "d_order",
    "datum_repend": "d_repair_end",
    "datum_wausgang": "d_goods_out",
}

# Raw position columns, in source spelling, mapped to our names.
POSITION_SOURCE_COLUMNS = {
    "SERVICEAUFTRAG": "order_id",
    "POSITION": "position",
    "ARTIKEL": "part_no",
    "NAME": "part_name",
    "MENGE": "quantity_raw",
}

# Repair stage dates in process order (goods in ... goods out).
STAGE_DATES = [
    "d_goods_in",
    "d_repair_start",
    "d_repair_quote",
    "d_quote",
    "d_order",
    "d_repair_end",
    "d_goods_out",
]

# Part articles start with this prefix; everything else is not a repair part.
PART_PREFIX = "K0"

# Position articles that book labour instead of parts.
LABOUR_CODES = ("KK002", "KK060")

# Watched parts for the rule filter (antecedent and consequent must hit one).
WATCH_ITEMS = ("K04886A", "K04172", "K04785", "K03832", "K03640")

# Part-name translations, falling back to the original name.
PART_NAME_TRANSLATIONS = {
    "Kohlebürste UX1; 2412": "Carbon brush",
    "Rillenkugellager; 608 BRS": "Deep groove ball bearing",
    "Dichtring; 4,5 x 7 x 1  U-Seal Standard": "U-Seal Standard",
    "Öl; 80ml": "Oil 80ml",
    "Kabelklammer, Polyethylen; Größe 4": "Cable clamp, polyethylene",
}

# Label joiner for multi-part itemsets.
ITEM_JOINER = "_und_"

# Cells read as missing (the default missing-value markers of pandas'
# CSV reader).  Text such as "none", "na", "-" or " NA" stays text.
NA_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Row-level date formats tried in this order (strptime notation).
DATE_FORMATS = (
    "%d-%m-%Y", "%d.%m.%Y", "%d/%m/%Y", "%Y-%m-%d", "%Y.%m.%d", "%Y/%m/%d",
    "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M",
    "%d.%m.%Y %H:%M",
)

# Formats accepted for period arguments (start / end of a report).
ARG_DATE_FORMATS = (
    "%d-%m-%Y", "%d.%m.%Y", "%d/%m/%Y", "%Y-%m-%d", "%Y.%m.%d", "%Y/%m/%d",
)

# Default workload: product type and report period.
DEFAULT_TYPE = "MAK-18"
DEFAULT_START = "01.07.2017"
DEFAULT_END = "01.07.2021"

# Default mining / clustering / forecasting parameters.
DEFAULT_MIN_SUPPORT = 0.5
DEFAULT_METRIC = "confidence"
DEFAULT_MIN_THRESHOLD = 0.5
DEFAULT_K_RANGE = (2, 10)
DEFAULT_TOP_N = 5
DEFAULT_QUANTILE = 0.9
DEFAULT_SEQUENCE_LENGTH = 12
DEFAULT_TRAIN_FRACTION = 0.8

# ---------------------------------------------------------------------------
# Derived names
# ---------------------------------------------------------------------------

STAGE_SHORT = {
    "d_goods_in": "goods_in",
    "d_repair_start": "repair_start",
    "d_repair_quote": "repair_quote",
    "d_quote": "quote",
    "d_order": "order",
    "d_repair_end": "repair_end",
    "d_goods_out": "goods_out",
}

STAGE_DURATIONS = [
    f"wd_{STAGE_SHORT[a]}_{STAGE_SHORT[b]}" for a, b in zip(STAGE_DATES, STAGE_DATES[1:])
]
LEAD_TIME = "wd_lead_time"
# Lead time first, then the six stages: the order of the KPI bars.
DURATION_COLUMNS = [LEAD_TIME] + STAGE_DURATIONS

HEADER_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in HEADER_SOURCE_COLUMNS]
)
POSITION_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in POSITION_SOURCE_COLUMNS]
)
