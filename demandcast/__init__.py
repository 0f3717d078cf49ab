"""Monthly demand-forecasting pipeline on Spark DataFrames."""
