"""Operators of a training-data pipeline (text cleaning, matching, tokens, archives).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only where the package can be imported.
"""
