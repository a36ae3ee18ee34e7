"""Conform, quality, dimension, fact and governance operators."""
