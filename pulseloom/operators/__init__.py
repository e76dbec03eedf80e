"""DataFrame-to-DataFrame operators: parse, validate, dedup, serve, write."""
