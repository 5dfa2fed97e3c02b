"""Column functions (no actions, no state)."""
