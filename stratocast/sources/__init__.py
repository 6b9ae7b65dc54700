"""stratocast.sources."""
