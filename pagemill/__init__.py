"""pagemill: document-package analytics and corpus preparation on Spark DataFrames."""
