"""ledgerstar: bank transactions to a checked star schema and carbon analytics, on Spark."""

__version__ = "0.1.0"
