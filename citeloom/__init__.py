"""A Spark-native engine for bibliographic works: ingest, index, change tracking, matching and evaluation."""
