"""Text scans, tables and sinks."""
