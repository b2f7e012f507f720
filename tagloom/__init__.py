"""Forum analytics as plain PySpark: every operator maps DataFrames to a DataFrame."""
