"""Compositions of operators: ledger updates, verified copies, whole runs."""
