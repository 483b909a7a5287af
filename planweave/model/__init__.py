"""The nested building model: schema, versions, and its tables."""
