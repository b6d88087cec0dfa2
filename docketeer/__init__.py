"""docketeer: court-ruling analytics on Spark DataFrames."""
