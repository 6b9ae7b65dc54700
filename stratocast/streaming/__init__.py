"""stratocast.streaming."""
