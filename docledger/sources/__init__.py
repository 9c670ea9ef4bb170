"""Tables, ledgers and files."""
