"""daybook: the daily general-ledger cycle as Spark DataFrame jobs."""
