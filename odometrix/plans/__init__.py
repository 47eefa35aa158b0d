"""Query plans: the operators composed into the questions they answer."""
