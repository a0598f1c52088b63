"""Market-data tables, streams and training-data pipelines on Spark DataFrames."""
