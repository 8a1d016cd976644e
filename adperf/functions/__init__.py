"""Column-level building blocks and the fixed values they use."""
