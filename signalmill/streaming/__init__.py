"""Running streams and bringing their batches into tables."""
