"""Stage plans: land, validate, refine, curate, serve, and whole runs."""
