"""Plans: the daily job, the query catalog and its SQL oracle."""
