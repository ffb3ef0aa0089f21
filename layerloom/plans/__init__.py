"""End-to-end loads built from the operators."""
