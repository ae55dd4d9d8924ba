"""Physical layout jobs and plan helpers."""
