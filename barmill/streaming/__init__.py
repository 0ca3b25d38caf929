"""Part of barmill: streaming."""
