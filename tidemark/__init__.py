"""tidemark: a Spark-native engine that keeps a search-ready document index in step with a change log."""
