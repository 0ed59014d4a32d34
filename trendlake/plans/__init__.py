"""Table builds composed from operators, the report queries, and the whole run."""
