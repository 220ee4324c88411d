"""Sources: driver-table adapters, log ingest, change-event routing, connectors."""
