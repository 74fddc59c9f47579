"""Where frames come from and where they go."""
