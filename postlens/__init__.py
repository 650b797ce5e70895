"""Spark-native observation engine for dated snapshots of postings."""
