"""Whole jobs, and the declarations of the one dataset they ship with."""
