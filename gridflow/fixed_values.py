"""Names, defaults, limits and message texts that results must carry as they are."""

from decimal import Decimal

# --- zones ----------------------------------------------------------------------------
GRID_ZONES = ("Zone-North", "Zone-South", "Zone-East", "Zone-West")

# --- what a household without a tariff row is billed ------------------------------------
DEFAULT_RATE = Decimal("0.15")
DEFAULT_TIER = "Standard"
DEFAULT_SUBSIDY = 0
SUBSIDY_DISCOUNT = Decimal("0.15")

# --- stream settings ---------------------------------------------------------------------
WATERMARK_DELAY = "10 seconds"
WINDOW_DURATION = "1 minute"
SLIDE_DURATION = "30 seconds"
TRIGGER_INTERVAL = "5 seconds"
TELEMETRY_TOPIC = "smart_meters"

# --- tariff gate -------------------------------------------------------------------------
TARIFF_COLUMNS = ("household_id", "tariff_rate", "billing_tier", "subsidy_flag")
RATE_LOW = Decimal("0.05")
RATE_HIGH = Decimal("1.50")
SUBSIDY_FLAGS = ("0", "1")
GATE_PASSED = "PASSED"
GATE_MISSING_FILE = "DQ Failure: Tariff file %s does not exist."
GATE_MISSING_COLUMNS = "DQ Failure: Missing mandatory columns: %s"
GATE_EMPTY = "DQ Failure: Tariff dataset is empty (0 records)."
GATE_BAD_ROW = "DQ Failure at row %d: %s"
GATE_BAD_RATE = "Tariff rate %s out of valid bounds [%s, %s]"
GATE_BAD_FLAG = "Invalid subsidy flag %s"

# --- freshness ---------------------------------------------------------------------------
FRESHNESS_LIMIT_S = 300
HEALTHY, DEGRADED, INITIALIZING, UNAVAILABLE = "HEALTHY", "DEGRADED", "INITIALIZING", "UNAVAILABLE"
STREAM_COMPONENT = "PYSPARK_STREAM_SINK"

# --- orders ------------------------------------------------------------------------------
MAX_RETRIES = 3
BACKOFF_STEP_S = 0.15
ACCEPTED, RECOVERED, QUARANTINED = "SUCCESS", "RECOVERED_AFTER_RETRY", "DLQ_QUARANTINED"
STEP_SUCCESS, STEP_RETRY, STEP_FATAL, STEP_EXHAUSTED = "SUCCESS", "RETRY", "FATAL", "EXHAUSTED"
UNKNOWN_ORDER = "UNKNOWN"
UNKNOWN_PRODUCT = "Unknown"
REASON_MALFORMED = "Malformed schema: missing required Avro fields ('orderId', 'price')"
REASON_NOT_NUMERIC = "could not convert string to float: '%s'"
REASON_NEGATIVE = "Poison pill detected: negative price ($%s)"
REASON_NOT_FINITE = "non-finite price"
REASON_FORCED = "Forced poison pill: %s"
REASON_TRANSIENT = "Simulated transient socket timeout (Kafka broker ack timeout)"
REASON_EXHAUSTED = "Max retries (%d) exceeded"
NOTE_SUCCESS = "Avro message validated and processed on attempt %s"
