"""Operators for training data: each in a module of its own, queries in `queries`."""
