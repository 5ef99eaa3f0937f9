"""Versioned catalog tables."""
