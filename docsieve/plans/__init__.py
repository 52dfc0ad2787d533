"""Jobs that chain the operators, and the query registry."""
