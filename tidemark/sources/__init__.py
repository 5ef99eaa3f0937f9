"""External sources read in full or by extraction window."""
