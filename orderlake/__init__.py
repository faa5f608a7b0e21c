"""Food-delivery order and review analytics on Spark DataFrames."""
