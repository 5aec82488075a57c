"""Siltstone: history, reconciliation and data quality for daily feeds, on Spark."""
