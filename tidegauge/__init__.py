"""tidegauge: sequence, consistency and vote analytics on Spark DataFrames."""
