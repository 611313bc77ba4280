"""Jobs composed from the operators: layer builds and the query catalog."""
