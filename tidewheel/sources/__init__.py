"""Readers and writers: snapshots, topics and tables."""
