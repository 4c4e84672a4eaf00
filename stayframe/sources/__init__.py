"""Source tables: checked Parquet readers and the views mapped onto test tables."""
