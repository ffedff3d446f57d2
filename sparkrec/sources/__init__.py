"""Sources and sinks: the driver's Parquet tables, the derived rating views,
`::`-delimited text files, and snapshot / append writers."""
