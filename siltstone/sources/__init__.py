"""Reading feeds and keeping tables."""
