"""Training-data operators: every module takes DataFrames and returns DataFrames."""
