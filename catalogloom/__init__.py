"""catalogloom: page snapshots in, a clean and versioned catalog feed out."""
