"""The tracker's commands, made of the operators."""
