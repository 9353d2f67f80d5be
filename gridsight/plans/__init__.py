"""Composite outputs: cleaning run, star load, marts, views, analytics, measures."""
