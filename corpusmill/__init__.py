"""Corpus and run analytics on Spark: declarative DataFrame operators for training-data preparation and run analysis."""
