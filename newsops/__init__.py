"""Spark DataFrame operators for labelled-text datasets."""
