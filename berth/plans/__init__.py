"""Plans: the registered queries and the end-to-end jobs (reconcile,
standardise, load, reports)."""
