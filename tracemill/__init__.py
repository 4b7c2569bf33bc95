"""tracemill: a Spark-native engine for curating reasoning-trace training data."""
