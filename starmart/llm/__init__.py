"""Operators for training-data pipelines over documents and pages; nothing else in the library imports them."""
