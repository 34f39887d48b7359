"""News-corpus curation and summary evaluation on PySpark DataFrames."""
