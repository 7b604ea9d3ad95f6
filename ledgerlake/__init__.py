"""Spark-native preparation of company-quarter accounting panels and daily security prices."""
