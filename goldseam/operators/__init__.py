"""Operators: frames in, frames out, columns given by name."""
