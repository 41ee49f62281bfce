"""Spark-native admission, review and quality analytics over collections of agent episodes."""
