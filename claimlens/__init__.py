"""claimlens: claims scoring, monitoring and model governance on Spark DataFrames."""
