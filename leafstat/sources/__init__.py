"""Sources and sinks: the star-schema adapter, silver file I/O, landed payloads."""
