"""Ranking evaluation, rank fusion and query expansion as Spark DataFrame operators."""
