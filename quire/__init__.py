"""quire: Spark-native article ingestion, data-quality, dimension loading and
indicator analytics, written with the DataFrame API."""

__version__ = "0.1.0"
