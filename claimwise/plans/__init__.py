"""End-to-end batch jobs composed from operators."""
