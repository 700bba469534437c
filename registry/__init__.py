"""Every operator as a named query over the given tables, with the same question in SQL."""
