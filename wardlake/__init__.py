"""wardlake: a hospital lakehouse and analytics library on PySpark DataFrames."""
