"""Entity-by-month panel operators on PySpark DataFrames."""
