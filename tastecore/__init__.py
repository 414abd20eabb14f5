"""Spark DataFrame operators for play-count triplets and labelled feature tables."""
