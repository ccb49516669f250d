"""Tabular regression on Spark: prepare, split, encode, train, tune, evaluate."""
