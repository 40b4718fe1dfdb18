"""Bronze, silver and gold models composed from the operators."""
