"""Operators for preparing language-model training data, and the corpus pipeline's parts."""
