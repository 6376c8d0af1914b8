"""Scalar column functions (JVM built-ins only)."""
