"""Readers: files, topics, SQL tables and in-memory rows."""
