"""CSV union with lineage, guards, and report sinks."""
