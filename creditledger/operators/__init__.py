"""DataFrame-in, DataFrame-out steps of the graduation ledger."""
