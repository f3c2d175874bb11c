"""Composed transforms (silver, gold, serving, training) and the query catalog."""
