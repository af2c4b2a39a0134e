"""Operators for preparing text corpora for language-model training, each a Spark job."""
