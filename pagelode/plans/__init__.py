"""End-to-end retrieval built from the operators."""
