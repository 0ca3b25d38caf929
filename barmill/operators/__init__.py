"""Part of barmill: operators."""
