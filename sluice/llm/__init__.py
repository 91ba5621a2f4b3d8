"""Operators of a training-data pipeline: text in, cleaned and packed tokens out."""
