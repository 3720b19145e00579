"""Writers that a rerun leaves in the same state."""
