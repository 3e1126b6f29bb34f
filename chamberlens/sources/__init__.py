"""Readers, report sinks and the sensor views derived from the events table."""
