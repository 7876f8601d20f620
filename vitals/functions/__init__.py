"""Column-level building blocks: pure ``Column`` functions and aggregates."""
