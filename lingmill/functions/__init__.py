"""Column expressions: no joins, no actions, nothing that shuffles."""
