"""Published statistics, composed of the operators. Inputs and results are DataFrames."""
