"""Feature engineering, model fitting and evaluation on Spark DataFrames."""
