"""Incremental ingestion.  The reference has no streaming operators
(no watermarks, windows or state); its daily pull is re-expressed here as
an exactly-once file stream (``daily.ingest_daily``)."""
