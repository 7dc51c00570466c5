"""Payment-fraud analytics as plain functions over Spark DataFrames."""
