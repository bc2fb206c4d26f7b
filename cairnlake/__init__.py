"""Spark-native engine for geo-tabular data: ingestion, joins, a versioned catalog and large-scale data checks."""
