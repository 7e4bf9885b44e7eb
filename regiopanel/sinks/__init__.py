"""Tables and delimited exports."""
