"""Every operator as a query over the given tables, with SQL that computes the same."""

from docledger.registry import copies, inputs, ledgers, runs, scalars, sets  # noqa: F401
from docledger.registry.inputs import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "inputs"]
