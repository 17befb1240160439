"""Operators for preparing training text: one module per operator.

Nothing else in the library imports this subpackage; ``queries`` registers its
queries. The modules run their core work in Spark (scans, shuffles, joins,
aggregations) and use numpy on Arrow batches inside tasks.
"""
