"""Every operator and mart as a query over the given tables, with its oracle SQL."""
