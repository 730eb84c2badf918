"""Plans: the job graph (refresh), the query catalog and its SQL oracle."""
