"""kinspark: family-history data processing on Spark DataFrames."""
