"""Sources and sinks: driver-table bindings, delimited-text ingest, the
keyed Parquet view store and the submission message stream."""
