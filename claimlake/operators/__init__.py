"""DataFrame -> DataFrame operators: Silver loads, Gold tables, IBNR, reports, history."""
