"""Bronze, silver and gold builds of the invoice tables, and the query catalog."""
