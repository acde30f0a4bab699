"""DataFrame -> DataFrame operators; none starts a job."""
