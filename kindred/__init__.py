"""Record linkage on Spark DataFrames: normalise, block, score, learn, select, write and validate."""
