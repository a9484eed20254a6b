"""Input schemas, scans and sinks."""
