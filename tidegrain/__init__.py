"""tidegrain: sales, survey, energy and data-quality analytics as Spark jobs."""
