"""Graph operators: every function takes and returns DataFrames (or a Graph)."""
