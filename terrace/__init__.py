"""terrace: layered (bronze, silver, gold) tables declared as specs and run as Spark jobs."""
