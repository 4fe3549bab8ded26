"""Column expressions: no function here starts a job or needs a session."""
