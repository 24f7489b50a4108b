"""Receivables analytics as composable PySpark operators (DataFrame in, DataFrame out)."""
