"""Training-data operators: each in its own module, registered by ``catalog``."""
