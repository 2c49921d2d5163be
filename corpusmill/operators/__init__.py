"""DataFrame operators: corpus preparation, run logs, profiles, history, audits and sequences."""
