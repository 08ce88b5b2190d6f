"""Operators for preparing language-model training data, each DataFrame in, DataFrame out."""
