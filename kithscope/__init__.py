"""Audience analytics on Spark: score, rank, label and evaluate social accounts."""
