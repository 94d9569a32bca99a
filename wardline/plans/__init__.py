"""The reports and jobs a user runs, composed of the operators."""
