"""Reading, mapping, writing and checking tables."""
