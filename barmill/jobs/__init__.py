"""Part of barmill: jobs."""
