"""Report files, documents and tables to DataFrames."""
