"""stratocast.operators."""
