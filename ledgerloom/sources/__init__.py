"""Landing files, tables and snapshots as sources and sinks."""
