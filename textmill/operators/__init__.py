"""DataFrame operators: everything here takes DataFrames and returns DataFrames."""
