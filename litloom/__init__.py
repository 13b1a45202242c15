"""litloom: a Spark-native engine for biomedical literature ingestion and training-data preparation."""
