"""Property and household-income statistics as Spark DataFrame plans."""
