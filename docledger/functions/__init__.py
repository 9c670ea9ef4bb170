"""Column-to-column functions: paths, status codes, messages, times."""
