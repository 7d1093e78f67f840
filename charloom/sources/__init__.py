"""Sources and sinks: tables, text files and Parquet model directories."""
