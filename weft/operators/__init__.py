"""Graph operators: each one is a function over (vertices, edges) DataFrames."""
