"""Single-cell long-read analytics on Spark DataFrames, with corpus operators beside them."""
