"""Operators of a training-data pipeline over document, page, embedding and label tables."""
