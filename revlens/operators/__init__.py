"""DataFrame operators: each a function DataFrame -> DataFrame."""
