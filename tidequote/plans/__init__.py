"""Jobs a user runs, and the query registry."""
