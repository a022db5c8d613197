"""Readers: Kafka topics, Parquet layers, and the sample events table."""
