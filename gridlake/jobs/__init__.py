"""Batch jobs: each is a function of a session, a lake and an ``as_of``."""
