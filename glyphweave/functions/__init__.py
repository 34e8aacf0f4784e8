"""Column functions: Unicode classes and text scalars."""
