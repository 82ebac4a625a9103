"""fieldloom: field-extraction analytics on Spark DataFrames."""
