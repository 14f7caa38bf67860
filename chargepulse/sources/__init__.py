"""Sources: dimension text files, streams, JSON files, catalog and named SQL."""
