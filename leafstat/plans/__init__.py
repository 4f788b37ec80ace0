"""Plans: the silver set, gold marts and the query catalogue."""
