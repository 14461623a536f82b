"""Operators: DataFrame -> DataFrame transformations, chainable with ``df.transform``."""
