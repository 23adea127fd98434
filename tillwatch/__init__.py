"""Sales-table analytics and anomaly detection as lazily composed Spark DataFrames."""

__version__ = "0.1.0"
