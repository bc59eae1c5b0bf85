"""Every operator as a query over the given tables, with the SQL its result must equal."""
