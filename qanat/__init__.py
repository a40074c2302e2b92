"""qanat: a Spark-native engine for versioned document corpora and retrieval."""
