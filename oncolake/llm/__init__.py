"""Operators of a training-data pipeline: thirteen jobs over documents, pages, vectors and conversations."""
