"""Plans: batch composition, the query registry and its SQL oracle."""
