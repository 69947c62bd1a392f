"""Where frames come from and go to."""
