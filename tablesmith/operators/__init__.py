"""The table operations as functions from DataFrames to DataFrames."""
