"""Part of barmill: sources."""
