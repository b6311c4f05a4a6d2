"""tidemark: prediction-market analytics as Spark DataFrame / SQL / ML / Structured Streaming jobs."""

__version__ = "0.1.0"
