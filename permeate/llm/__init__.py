"""Operators of a training-data pipeline: text and web pages in, decisions per document out."""
