"""Corpus preparation for topic modelling, as Spark jobs."""
