"""Query catalogue: each registered query and its SQL oracle."""
