"""Part of barmill: functions."""
