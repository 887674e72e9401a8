"""Where lines and messages come from."""
