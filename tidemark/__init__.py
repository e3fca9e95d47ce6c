"""tidemark: event-log analytics as Spark DataFrame and Structured Streaming
operators.  See README.md for the operator map."""

__version__ = "0.1.0"
