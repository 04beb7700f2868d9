"""Table plans: staging rules per source, dimensions, facts, loads and whole jobs."""
