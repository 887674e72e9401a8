"""Where alerts, errors, metrics and reports go."""
