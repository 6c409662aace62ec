"""Operators for training-data corpora: texts, pages and conversations."""
