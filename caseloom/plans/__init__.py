"""The complaints configuration: which operators, on which columns, in which order."""
