"""Web-page interest harvesting and text classification as Spark jobs."""
