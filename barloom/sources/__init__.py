"""Readers, sinks and table publishing."""
