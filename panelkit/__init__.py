"""Consumer-panel analytics on Spark DataFrames."""
