"""millrace: evaluation-run analytics and text-corpus processing on Spark DataFrames."""
