"""The operators: ``f(DataFrames, config) -> DataFrame``, lazy."""
