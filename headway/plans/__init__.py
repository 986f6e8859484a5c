"""The data products, each a function from DataFrames to a lazy DataFrame."""
