"""Reports and the query registry."""
