"""siltbed: land nested records, settle them layer by layer, read the marts on top."""
