"""Operators of a training-data pipeline: thirteen methods over document tables."""
