"""Plans: the migration DAG, its summaries, and the catalogue of registered queries."""
