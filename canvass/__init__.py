"""canvass: evidence-cascade analytics on Spark DataFrames."""
