"""Readers and writers: datasets, JSON lines, training feeds, artifact listings."""
