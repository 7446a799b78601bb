"""Retail order normalisation as composable Spark DataFrame operators."""
