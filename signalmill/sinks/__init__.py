"""Writers: files, topics and SQL tables."""
