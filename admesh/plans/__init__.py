"""End-to-end queries from a folder of tables to an audience."""
