"""End-to-end plans wiring the operators together."""
