"""Sources and sinks: the Parquet lake, warehouse tables, the message bus,
run metadata."""
