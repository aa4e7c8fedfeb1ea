"""Operators of a training-data pipeline, with their queries and comparison SQL.

Nothing outside this package imports it, apart from the guarded import of the entry file.
"""
