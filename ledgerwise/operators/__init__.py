"""Pure DataFrame -> DataFrame operators (no actions, no I/O)."""
