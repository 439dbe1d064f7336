"""A log analytics engine on Spark DataFrames."""
