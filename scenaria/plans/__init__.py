"""End-to-end plans (prepare / train / evaluate) and the registered queries over the driver tables."""
