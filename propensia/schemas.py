"""Schemas and fixed values of the propensity data model.

Fixed values below must equal the original pipeline's for right results;
they are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Conversion rate used for KES amounts (USD = KES / 130.0).
KES_PER_USD = 130.0
# Validity bounds for amounts (strict on both ends).
AMOUNT_MIN_EXCLUSIVE = 0
AMOUNT_MAX_EXCLUSIVE = 10000000
# A token is the first 32 hex characters of HMAC-SHA256("<salt>:<pan>").
TOKEN_HEX_CHARS = 32
# Channel / transaction type vocabularies of the silver layer.
DIGITAL_CHANNELS = ["mobile", "app", "online"]
CHANNEL_VALUES = ["digital", "branch", "atm", "agent", "unknown"]
PURCHASE_TYPES = ["purchase", "pos"]
TRANSFER_TYPES = ["transfer", "p2p"]
TRANSACTION_TYPE_VALUES = ["purchase", "transfer", "withdrawal", "deposit", "bill_pay", "other"]
# Merchant category groups from MCC ranges (inclusive), first match wins.
MCC_RANGES = [
    ("grocery_retail", 5411, 5499),
    ("food_beverage", 5812, 5814),
    ("transport_travel", 4111, 4789),
    ("financial_services", 6010, 6051),
]
MCC_OTHER = "other"
MERCHANT_GROUPS = ["grocery_retail", "food_beverage", "transport_travel", "financial_services", "other"]
# Merchant category seed (merchant_mcc, merchant_category_group), file order.
MCC_SEED = [
    (4111, "transport_travel"),
    (4121, "transport_travel"),
    (4511, "transport_travel"),
    (4722, "transport_travel"),
    (4789, "transport_travel"),
    (5411, "grocery_retail"),
    (5422, "grocery_retail"),
    (5441, "grocery_retail"),
    (5499, "grocery_retail"),
    (5812, "food_beverage"),
    (5813, "food_beverage"),
    (5814, "food_beverage"),
    (6010, "financial_services"),
    (6011, "financial_services"),
    (6012, "financial_services"),
    (6050, "financial_services"),
    (6051, "financial_services"),
    (5541, "other"),
    (5732, "other"),
    (7999, "other"),
]
# Engagement segments: (min txn_count_30d, min digital_ratio_30d or None, name).
ENGAGEMENT_RULES = [(20, 0.7, "power_digital"), (10, 0.4, "active_digital"), (5, None, "casual")]
ENGAGEMENT_DEFAULT = "dormant"
ENGAGEMENT_VALUES = ["power_digital", "active_digital", "casual", "dormant"]
# Campaign segments by decile: (min decile, name), first match wins.
CAMPAIGN_RULES = [(9, "TARGET_PREMIUM"), (7, "TARGET_STANDARD"), (4, "NURTURE")]
CAMPAIGN_DEFAULT = "EXCLUDE"
CAMPAIGN_VALUES = ["TARGET_PREMIUM", "TARGET_STANDARD", "NURTURE", "EXCLUDE"]
# Rolling windows are counted in active-day rows, diversity in calendar days.
ROW_WINDOWS = [7, 30, 90]
DIVERSITY_CALENDAR_DAYS = 30
# Model input contract (order matters for the feature vector).
FEATURE_COLUMNS = [
    "recency_days",
    "txn_count_30d",
    "volume_30d",
    "digital_ratio_30d",
    "cross_border_count_90d",
    "age",
    "tenure_months",
]
# Public request field -> model feature name.
MODEL_INPUT_MAP = {
    "recency_days": "recency_days",
    "frequency_30d": "txn_count_30d",
    "monetary_30d": "volume_30d",
    "digital_ratio_30d": "digital_ratio_30d",
    "cross_border_count_90d": "cross_border_count_90d",
    "age": "age",
    "tenure_months": "tenure_months",
}
REQUEST_FIELDS = sorted(MODEL_INPUT_MAP)
BASE_ADOPTION_RATE = 0.03
# Classifier settings: depth 4, learning rate 0.05, 200 rounds, seed 42;
# isotonic calibration over 3 folds; 30-day temporal hold-out; top 10 %.
GBT_MAX_DEPTH = 4
GBT_STEP_SIZE = 0.05
GBT_MAX_ITER = 200
GBT_SEED = 42
CALIBRATION_FOLDS = 3
HOLDOUT_DAYS = 30
TOP_FRACTION = 0.10
# Behaviour index: weights of the propensity signal and its clip.
SIGNAL_WEIGHTS = {
    "frequency_z": 0.55,
    "volume_z": 0.35,
    "digital_ratio": 0.80,
    "cross_border_count": 0.12,
    "age_minus_40": 0.015,
    "tenure_months": 0.004,
}
SIGMOID_CLIP = 40.0
# Response texts of the request scorer.
ERROR_NOT_JSON = "Request body must be valid JSON."
ERROR_NOT_OBJECT = "Request body must be a JSON object."
ERROR_MISSING = "Missing required fields: "
ERROR_NOT_NUMERIC = "Fields must be numeric: "
ERROR_SCORING = "Model load or scoring failed."
ERROR_RATIO = "digital_ratio_30d must be between 0 and 1."
STD_FLOOR = 1e-6
# --- end of fixed values ----------------------------------------------------

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("customer_token", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("transaction_timestamp", T.TimestampNTZType()),
        T.StructField("channel", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("merchant_mcc", T.IntegerType()),
        T.StructField("is_cross_border", T.BooleanType()),
        T.StructField("customer_age", T.LongType()),
        T.StructField("tenure_months", T.LongType()),
        T.StructField("_ingestion_date", T.DateType()),
        T.StructField("_ingestion_timestamp", T.TimestampType()),
        T.StructField("_batch_id", T.StringType()),
    ]
)

RAW_LABELS = T.StructType(
    [
        T.StructField("customer_token", T.StringType()),
        T.StructField("adopted_card", T.IntegerType()),
        T.StructField("age", T.LongType()),
        T.StructField("tenure_months", T.LongType()),
        T.StructField("label_date", T.DateType()),
        T.StructField("_ingestion_date", T.DateType()),
        T.StructField("_ingestion_timestamp", T.TimestampType()),
        T.StructField("_batch_id", T.StringType()),
    ]
)

SEED_SCHEMA = "merchant_mcc int, merchant_category_group string"

# Bronze contract: (source column, target type, target name).
BRONZE_CONTRACT = [
    ("customer_token", "string", "customer_token"),
    ("transaction_id", "string", "transaction_id"),
    ("amount", "double", "amount"),
    ("currency", "string", "currency"),
    ("transaction_timestamp", "timestamp_ntz", "transaction_timestamp"),
    ("channel", "string", "channel"),
    ("transaction_type", "string", "transaction_type"),
    ("merchant_mcc", "int", "merchant_mcc"),
    ("is_cross_border", "boolean", "is_cross_border"),
    ("customer_age", "int", "age"),
    ("tenure_months", "int", "tenure_months"),
    ("_ingestion_date", "date", "_ingestion_date"),
    ("_ingestion_timestamp", "timestamp_ntz", "_ingestion_timestamp"),
    ("_batch_id", "string", "_batch_id"),
]

SCORE_COLUMNS = ["customer_token", "propensity_score", "score_decile", "campaign_segment", "feature_date"]
