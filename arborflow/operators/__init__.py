"""Graph, delta, merge and audit operators over DataFrames."""
