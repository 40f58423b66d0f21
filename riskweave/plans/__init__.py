"""End-to-end jobs composed from the operators."""
