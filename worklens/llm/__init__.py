"""Operators for preparing training data, each in a module of its own.

Nothing outside this package imports it; ``queries.py`` registers one query per
operator and the pipeline.
"""
