"""Sources and sinks: the trip adapter, Bronze pages and manifest, JSON documents, table schemas."""
