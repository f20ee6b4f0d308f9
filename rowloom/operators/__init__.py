"""Matrix operators: each takes and returns DataFrames in one of the three matrix forms."""
