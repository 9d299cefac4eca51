"""Query plans composed from sources and operators (the registered query catalog, daily jobs)."""
