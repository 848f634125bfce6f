"""Operators on text corpora for training data: one module per operator, thin queries in ``llm.queries``."""
