"""Example models."""
