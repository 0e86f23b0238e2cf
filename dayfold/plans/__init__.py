"""Reports built from operators, and the queries the driver runs."""
