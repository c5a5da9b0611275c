"""Composed plans: pipelines P1-P4, warehouse questions, driver queries."""
