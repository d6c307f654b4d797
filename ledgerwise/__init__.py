"""ledgerwise: data-quality, reconciliation and SCD2 history as Spark DataFrame operators."""

__version__ = "0.1.0"
