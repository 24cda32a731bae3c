"""Sources: change events, files, declared catalogs."""
