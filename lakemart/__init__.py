"""lakemart: a layered sales warehouse and its analytics as ordinary Spark jobs."""
