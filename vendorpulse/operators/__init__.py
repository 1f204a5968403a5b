"""Feature operators: pre-aggregates, as-of facts, layer-1 families, layer-2 ratios, scoring."""
