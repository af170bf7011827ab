"""Reading registries, feeds, pages and stores; writing stores, exports and events."""
