"""Spark-first engine for turning document streams into linked, searchable tables."""
