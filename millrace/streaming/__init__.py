"""Incremental jobs: each run takes exactly the files that arrived since the last one."""
