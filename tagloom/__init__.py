"""Catalogue preparation, label engineering, vector similarity and recommender evaluation on Spark."""

__version__ = "0.1.0"
