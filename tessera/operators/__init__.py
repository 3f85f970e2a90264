"""DataFrame operators, one module per analysis family."""
