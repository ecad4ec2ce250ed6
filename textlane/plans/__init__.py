"""Composed plans: the query catalog, its SQL oracle and the pipelines."""
