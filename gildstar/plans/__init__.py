"""The thirteen dataflows: staging, intermediate, dimensions, facts, and their checks."""
