"""Plans: the semantic (metrics) layer, the load pipeline and the query catalog."""
