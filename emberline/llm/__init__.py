"""Operators for building training corpora. Nothing else in emberline imports this package."""
