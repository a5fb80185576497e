"""Dataset builds, quality gates, a versioned catalog and metric analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
