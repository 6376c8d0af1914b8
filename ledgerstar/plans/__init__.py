"""Plans: staging, gold load, analytics, end-to-end medallion run."""
