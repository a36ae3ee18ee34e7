"""Vital-sign stream operators and sinks."""
