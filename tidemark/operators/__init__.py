"""DataFrame-to-DataFrame operators; nothing in here writes."""
