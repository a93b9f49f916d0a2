"""Bronze-to-silver data processing and analyst queries on Spark DataFrames."""
