"""Steps that take and return DataFrames."""
