"""Operators for training-data pipelines over document, embedding and conversation tables."""
