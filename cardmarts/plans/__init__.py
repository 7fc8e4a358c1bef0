"""Table builders (silver, gold) and the layer runner."""
