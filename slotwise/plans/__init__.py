"""Plans: the daily run (I11) and the query catalogue."""
