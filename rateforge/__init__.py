"""rateforge: rating features and rating prediction on Spark DataFrames."""
