"""Data-quality rules over a building model and the gate before an export."""
