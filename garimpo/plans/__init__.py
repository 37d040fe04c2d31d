"""Composed jobs: silver steps, gold models, market and run reports."""
