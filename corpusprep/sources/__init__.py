"""Tables, mappings and word lists that a run starts from, and where results go."""
