"""Operators of a training-data pipeline: tokenizing, search, licences, models and near-duplicates.

Nothing else in the library imports this package. ``registry`` lists its queries and their SQL.
"""
