"""Operators for preparing language-model training data.

Nothing else in the library imports this package.  Every operator is a
function from DataFrames to a DataFrame; ``queries.py`` holds the registered
``opN_*`` queries, which call the operators with production parameters.
"""
