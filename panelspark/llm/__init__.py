"""Operators of a training-data pipeline, one module each, and their queries.

Nothing else in the library imports this package. ``catalog`` lists the
registered queries; ``sql`` holds the DuckDB SQL of those that SQL can express.
"""
