"""Load specifications, extraction windows, the load log and the runner."""
