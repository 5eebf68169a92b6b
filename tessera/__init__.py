"""tessera: a Spark-native engine for building, auditing and searching large text corpora."""
