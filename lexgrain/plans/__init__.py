"""Plan helpers: lineage, bounded control data, skew; and the query catalogue."""
