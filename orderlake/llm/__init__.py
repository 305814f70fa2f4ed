"""Operators of a training-data pipeline: whole texts in, one row or digest per document out."""
