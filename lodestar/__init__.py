"""Spark-native analytics library: lazy DataFrame operators, reports, streaming and MLlib pipelines."""
