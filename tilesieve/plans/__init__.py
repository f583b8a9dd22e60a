"""Jobs that string the operators together."""
