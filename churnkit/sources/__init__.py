"""Sources and sinks: the event-log adapter over the test tables, and the
JSON / CSV / Parquet / model round trips."""
