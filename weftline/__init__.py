"""Spark-first engine for reconciling market contracts across venues."""
