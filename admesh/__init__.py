"""Choose the users to show an advertisement to, as Spark jobs."""
