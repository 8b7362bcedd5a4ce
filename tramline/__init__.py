"""Transit-schedule and arrival analytics on Spark DataFrames."""
