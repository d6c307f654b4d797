"""Transaction feeds, ledgers and NDJSON lines derived from the test tables.

The defect mix is a fixed rule over ``o_orderkey`` (``k``), so every row of
``orders`` contributes and the work grows with the table. The same rules are
written in SQL for the oracle (``ledgerwise.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Run date of every query over the test tables, and the two
# SCD2 run times (first load, the updated feed, a third feed).
RUN_DATE = "2001-07-01"
RUN_TS_INITIAL = "2001-07-01 09:00:00"
RUN_TS_UPDATED = "2001-07-01 15:00:00"
RUN_TS_THIRD = "2001-07-02 09:00:00"

# Schema the event NDJSON lines are parsed with.
EVENT_LINE_SCHEMA = StructType([StructField("transaction_id", StringType()), StructField("amount", DoubleType())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.col("o_orderkey")


def _mod(n: int, r: int) -> Column:
    return (_k() % n) == r


def _id_text() -> Column:
    return F.concat(F.lit("TXN"), F.lpad(_k().cast("string"), 9, "0"))


def _status() -> Column:
    # Order status -> transaction status.
    return (
        F.when(F.col("o_orderstatus") == "F", "SETTLED")
        .when(F.col("o_orderstatus") == "P", "PENDING")
        .when(F.col("o_orderstatus") == "O", "FAILED")
    )


def _date_text() -> Column:
    return F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")


def _feed_with_key(orders: DataFrame) -> DataFrame:
    """Feed rows with ``_k``. The later copy of an order is generated by
    ``explode`` in the same pass, so ``orders`` is scanned once."""
    o = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", _date_text().alias("_day")
    )
    day = F.col("_day")
    copy = F.col("_copy")
    base_amount = (
        F.when(_mod(41, 5), -F.col("o_totalprice"))
        .when(_mod(83, 7), F.lit(0.0))
        .when(_mod(89, 1), F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice"))
    )
    hour = F.when(copy, F.lit("23")).otherwise(F.lpad((_k() % 20).cast("string"), 2, "0"))
    return o.select(
        "*", F.explode(F.when(_mod(37, 11), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("_copy")
    ).select(
        _k().alias("_k"),
        F.when(_mod(40, 3), F.lit(None).cast("string")).otherwise(_id_text()).alias("transaction_id"),
        F.concat(F.lit("ACC"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("account_id"),
        F.when(copy, base_amount + F.lit(1.5)).otherwise(base_amount).alias("amount"),
        F.when(_k() % 3 == 0, "USD").when(_k() % 3 == 1, "EUR").otherwise("GBP").alias("currency"),
        F.when(_mod(43, 7), F.lit("not-a-date")).otherwise(day).alias("transaction_date"),
        _status().alias("status"),
        F.when(_mod(97, 2), F.lit(None).cast("string"))
        .otherwise(F.concat(day, F.lit("T"), hour, F.lit(":15:00")))
        .alias("updated_at"),
    )


FEED_COLUMNS = ["transaction_id", "account_id", "amount", "currency", "transaction_date", "status", "updated_at"]


def transaction_feed(orders: DataFrame) -> DataFrame:
    """The initial transaction feed (raw string dates, one row per order plus
    a later copy for some orders)."""
    return _feed_with_key(orders).select(*FEED_COLUMNS)


def updated_transaction_feed(orders: DataFrame) -> DataFrame:
    """The second feed: some rows absent, some amounts and statuses changed."""
    f = _feed_with_key(orders).filter(F.col("_k") % 29 != 10)
    return f.select(
        "transaction_id",
        "account_id",
        F.when(F.col("_k") % 19 == 8, F.col("amount") + F.lit(50.0)).otherwise(F.col("amount")).alias("amount"),
        "currency",
        "transaction_date",
        F.when(F.col("_k") % 23 == 9, F.lit("REVERSED")).otherwise(F.col("status")).alias("status"),
        "updated_at",
    )


def third_transaction_feed(orders: DataFrame) -> DataFrame:
    """A third feed: other rows absent (those absent from the second feed are
    back), amounts of the second feed changed again, further ones anew."""
    f = _feed_with_key(orders).filter(F.col("_k") % 31 != 4)
    return f.select(
        "transaction_id",
        "account_id",
        F.when(F.col("_k") % 38 == 8, F.col("amount") + F.lit(75.0))
        .when(F.col("_k") % 19 == 8, F.col("amount") + F.lit(50.0))
        .when(F.col("_k") % 47 == 3, F.col("amount") + F.lit(5.0))
        .otherwise(F.col("amount"))
        .alias("amount"),
        "currency",
        "transaction_date",
        "status",
        "updated_at",
    )


def repeated_ledger_feed(orders: DataFrame) -> DataFrame:
    """The ledger with defects of its own: some ids occur a second time, a
    month on and with another amount, some as an exact copy, and some rows have
    no id."""
    k = F.substring("transaction_id", 4, 9).cast("bigint")
    led = ledger_feed(orders).withColumn("_k", k)
    later = F.col("_k") % 21 == 2
    kinds = F.when(later, F.array(F.lit(0), F.lit(1))).when(F.col("_k") % 33 == 7, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    rows = led.withColumn("_kind", F.explode(kinds))
    moved = F.date_format(F.add_months(F.col("cleared_date").cast("date"), 1), "yyyy-MM-dd")
    return rows.select(
        F.when(F.col("_k") % 45 == 11, F.lit(None).cast("string")).otherwise(F.col("transaction_id")).alias("transaction_id"),
        "cleared_flag",
        F.when(F.col("_kind") == 1, moved).otherwise(F.col("cleared_date")).alias("cleared_date"),
        F.when(F.col("_kind") == 1, F.col("ledger_amount") + F.lit(1.0)).otherwise(F.col("ledger_amount")).alias("ledger_amount"),
        "ledger_status",
    )


def ledger_feed(orders: DataFrame) -> DataFrame:
    """Ledger rows: most orders, some amounts off by 10, some statuses off."""
    o = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate").filter(~_mod(11, 9))
    return o.select(
        _id_text().alias("transaction_id"),
        F.lit("Y").alias("cleared_flag"),
        _date_text().alias("cleared_date"),
        F.when(_mod(13, 4), F.col("o_totalprice") + F.lit(10.0)).otherwise(F.col("o_totalprice")).alias(
            "ledger_amount"
        ),
        F.when(_mod(17, 6), F.lit("REVERSED"))
        .when(_mod(59, 0), F.lit(None).cast("string"))
        .otherwise(_status())
        .alias("ledger_status"),
    )


def event_json_lines(events: DataFrame) -> DataFrame:
    """One NDJSON line per event (column ``value``); some truncated, some with
    a non-numeric amount."""
    eid = F.col("event_id")
    head = F.concat(F.lit('{"transaction_id":"E'), eid.cast("string"), F.lit('","amount":'))
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    line = (
        F.when(eid % 50 == 7, head)
        .when(eid % 70 == 9, F.concat(head, F.lit('"N/A"}')))
        .otherwise(F.concat(head, cents, F.lit("}")))
    )
    return events.select(line.alias("value"))


def ledger_json_lines(orders: DataFrame) -> DataFrame:
    """One NDJSON line per ledger row; amounts in integer cents; a few lines
    start with a doubled brace (malformed)."""
    o = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate").filter(~_mod(11, 9))
    status = (
        F.when(_mod(17, 6), F.lit("REVERSED")).when(_mod(59, 0), F.lit(None).cast("string")).otherwise(_status())
    )
    status_json = F.coalesce(F.concat(F.lit('"'), status, F.lit('"')), F.lit("null"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    body = F.concat(
        F.lit('"transaction_id":"'),
        _id_text(),
        F.lit('","cleared_flag":"Y","cleared_date":"'),
        _date_text(),
        F.lit('","ledger_amount":'),
        cents,
        F.lit(',"ledger_status":'),
        status_json,
        F.lit("}"),
    )
    line = F.when(_mod(53, 5), F.concat(F.lit("{{"), body)).otherwise(F.concat(F.lit("{"), body))
    return o.select(line.alias("value"))
