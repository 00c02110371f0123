"""Training-data operators: one module per operator, ``catalog`` registers their queries."""
