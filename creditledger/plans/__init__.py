"""The steps in order, from input tables to published status."""
