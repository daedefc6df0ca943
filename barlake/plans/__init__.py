"""Plans that chain operators: the warehouse build, the refresh job and the
registry of named queries."""
