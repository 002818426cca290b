"""Spark-native library for building and exploring catalogues of bibliographic records."""
