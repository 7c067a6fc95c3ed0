"""Jobs composed of the operators, and the registry of stand-in queries used for checks."""
