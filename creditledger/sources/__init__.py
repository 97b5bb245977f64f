"""Where the input tables come from and where results go."""
