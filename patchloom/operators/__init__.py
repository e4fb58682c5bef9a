"""Table operators: each function takes and returns ``DataFrame``."""
