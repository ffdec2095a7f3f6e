"""Raw files to DataFrames."""
