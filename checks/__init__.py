"""Every operator as a query over the given tables, with the SQL it must agree with."""
