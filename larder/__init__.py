"""larder: a commerce warehouse toolkit on PySpark DataFrames."""
