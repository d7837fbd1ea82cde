"""Session-event lakehouse built from PySpark DataFrame and Structured Streaming operators."""

__version__ = "0.1.0"
