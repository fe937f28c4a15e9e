"""Column-level helpers: everything here maps columns to columns and stays inside one stage."""
