"""DataFrame -> DataFrame operators. None of them runs a job; each returns a lazy plan."""
