"""DataFrame-to-DataFrame operators: vertex records, graph, scores, selection."""
