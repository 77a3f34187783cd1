"""Plans: pipeline stages, the ordered run, and the queries over the driver tables."""
