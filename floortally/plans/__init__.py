"""Report plans: every function takes Tables and parameters and returns a lazy DataFrame."""
