"""DataFrame operators of the booking model."""
