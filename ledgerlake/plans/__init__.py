"""End-to-end plans: query API, history build, daily update, fixtures and
the query catalogue used by ``__spark_entry__``."""
