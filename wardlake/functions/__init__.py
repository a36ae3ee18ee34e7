"""Column-level helpers and the skew-safe ordering primitives."""
