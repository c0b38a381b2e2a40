"""Jobs that fill the warehouse, and the registered queries with their oracles."""
