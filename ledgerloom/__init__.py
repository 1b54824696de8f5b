"""Spark-native analytics over chain data, with text-corpus operators in `llm`."""
