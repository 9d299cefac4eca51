"""DataFrame → DataFrame operators of the medallion pipeline."""
