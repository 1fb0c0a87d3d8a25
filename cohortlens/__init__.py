"""Retail analytics on Spark: validate, profile, featurise, split, segment, score."""
