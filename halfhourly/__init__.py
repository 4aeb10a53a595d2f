"""Half-hourly electricity-market analytics on Spark DataFrames."""
