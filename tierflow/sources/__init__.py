"""Sources: record contracts, JSON document landing and fixture readers."""
