"""Writers: date-partitioned Parquet tables and the serving table."""
