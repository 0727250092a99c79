"""Column-level building blocks: every function here returns ``Column`` expressions."""
