"""Fixed values of the data contract: schemas, flag and status domains, formats.

Everything in this module is a value that must stay exactly as written for
results to match the established flagging / reconciliation semantics.
"""

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# --- Fixed values: flag domain, in rule priority order --------------------
FLAG_OK = "OK"
FLAG_NULL_ID = "NULL_ID"
FLAG_NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
FLAG_INVALID_DATE = "INVALID_DATE"
FLAG_DUPLICATE = "DUPLICATE"
FLAG_CORRUPT_JSON = "CORRUPT_JSON"
QUARANTINE_FLAGS = [FLAG_NULL_ID, FLAG_NEGATIVE_AMOUNT, FLAG_INVALID_DATE, FLAG_DUPLICATE, FLAG_CORRUPT_JSON]

# --- Fixed values: reconciliation status domain, in priority order --------
RECON_UNRECONCILED = "UNRECONCILED"
RECON_AMOUNT_MISMATCH = "AMOUNT_MISMATCH"
RECON_STATUS_MISMATCH = "STATUS_MISMATCH"
RECON_MATCHED = "MATCHED"
RECON_STATUSES = [RECON_MATCHED, RECON_AMOUNT_MISMATCH, RECON_STATUS_MISMATCH, RECON_UNRECONCILED]

# --- Fixed values: quarantine stages ---------------------------------------
STAGE_INGEST_TRANSACTIONS = "INGEST_TRANSACTIONS"
STAGE_INGEST_LEDGER = "INGEST_LEDGER"
STAGE_TRANSFORM = "TRANSFORM"
STAGE_RECONCILE_LEDGER = "RECONCILE_LEDGER"

# --- Fixed values: SCD2 -----------------------------------------------------
SCD2_TRACKED_FIELDS = ["amount", "status", "recon_status"]
SCD2_OPEN_END = "2199-12-31 00:00:00"

# --- Fixed values: text formats ----------------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"

CORRUPT_COL = "_corrupt_record"

TRANSACTION_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("account_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("transaction_date", StringType()),
        StructField("status", StringType()),
        StructField("updated_at", StringType()),
    ]
)

LEDGER_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("cleared_flag", StringType()),
        StructField("cleared_date", StringType()),
        StructField("ledger_amount", DoubleType()),
        StructField("ledger_status", StringType()),
    ]
)

TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]
LEDGER_COLUMNS = [f.name for f in LEDGER_SCHEMA.fields]

# Columns of the reconciled table (feed columns, parsed, plus the status).
RECONCILED_COLUMNS = TRANSACTION_COLUMNS + ["recon_status"]

CURATED_COLUMNS = [
    "transaction_id",
    "account_id",
    "amount",
    "currency",
    "transaction_date",
    "status",
    "recon_status",
    "effective_start_date",
    "effective_end_date",
    "is_current",
]

QUARANTINE_COLUMNS = ["transaction_id", "raw_payload", "source_file", "stage", "dq_flag"]
