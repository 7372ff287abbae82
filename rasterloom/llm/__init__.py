"""Operators for training-data pipelines; ``queries`` and ``oracles`` register one query for each of them."""
