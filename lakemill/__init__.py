"""Analytics operators and jobs built on Spark DataFrames, SQL and Structured Streaming."""
