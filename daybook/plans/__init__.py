"""Jobs: ingest flows, reports, locality snapshot and archiving."""
