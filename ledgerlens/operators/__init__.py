"""DataFrame -> DataFrame operators, one module per job of the reference."""
