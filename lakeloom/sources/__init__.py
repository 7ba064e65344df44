"""Reading sources and reading and writing layers."""
