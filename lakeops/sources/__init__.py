"""Reading and incrementally loading files, records and databases."""
