"""tessera: Spark-native tabular feature engineering and model comparison."""
