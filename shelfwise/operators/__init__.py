"""Generic DataFrame operators; column names are parameters so the same code
serves the lending schema and any other table."""
