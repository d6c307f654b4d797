"""Plans: the end-to-end batch run, the scenario over the test tables, and
the registry of named queries with their SQL oracles."""
