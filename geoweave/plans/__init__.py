"""Driver-side plans: the iteration kernel, partitioning policy and the registered queries."""
