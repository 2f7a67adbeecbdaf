"""Every operator as a query on the order tables, with the SQL that it must equal."""
