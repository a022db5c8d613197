"""Writers: Parquet layers and Kafka records."""
