"""DataFrame -> DataFrame operators of the profile job."""
