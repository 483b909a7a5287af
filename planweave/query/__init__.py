"""Plain questions about a building, answered by the first pattern that fits."""
