"""DataFrame to DataFrame operators: windows, joins, dedup, graph, vectors, states, splits, gates."""
