"""stratocast.plans."""
