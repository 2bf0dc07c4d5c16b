"""Analytics over unspent-output ledgers, written as Spark DataFrame jobs."""
