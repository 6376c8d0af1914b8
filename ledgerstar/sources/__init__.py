"""Sources: bronze derivation, files, catalog tables, reference data."""
