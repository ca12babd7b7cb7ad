"""titlemill: turn a large table of bare titles into described, embedded records with Spark jobs."""
