"""Business plans put together from the operators."""
