"""Query catalogue and search jobs."""
