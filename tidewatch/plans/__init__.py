"""The published panels, each a function from feeds to a DataFrame."""
