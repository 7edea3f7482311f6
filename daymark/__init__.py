"""Daily user metrics from raw application events, built on Spark DataFrames."""
