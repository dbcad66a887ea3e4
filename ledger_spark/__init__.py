"""Labelling of financial transactions as Spark DataFrame operators."""
