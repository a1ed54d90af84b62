"""Corpus statistics and document batches, written as Spark DataFrame operators."""
