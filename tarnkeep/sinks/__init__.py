"""Writers: load targets with a staged swap, and log tables."""
