"""Document-transfer ledgers as Spark jobs: worklists, distributed dispatch, keyed merges."""
