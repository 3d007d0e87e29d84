"""Complete runs put together from the operators."""
