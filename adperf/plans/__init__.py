"""Layer compositions and the registry of named queries."""
