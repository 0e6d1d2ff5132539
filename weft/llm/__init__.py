"""Operators of a training-data pipeline (one module each) and their queries.

Nothing outside this folder imports it; ``registry.queries()`` and
``registry.oracle_sql()`` list what it offers.
"""
