"""Knowledge graphs from text, as plain DataFrame functions."""
