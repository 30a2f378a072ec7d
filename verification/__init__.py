"""Every operator, model and report as a query over the given tables, beside its SQL."""
