"""Complete jobs composed from operators."""
