"""The daily jobs, composed from sources, operators and sinks."""
