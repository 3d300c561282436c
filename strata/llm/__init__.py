"""Operators of a training-data pipeline (tokenising, search, dedup, filters, sharding, chat formatting).

Nothing else in the library imports this subpackage.  ``queries.py`` registers one query per operator.
"""
