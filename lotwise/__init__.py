"""lotwise: marketplace, warehouse, queue and search analytics on Spark DataFrames."""
