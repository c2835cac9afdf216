"""Plans: the table builders, marts, page plan and the registered queries."""
