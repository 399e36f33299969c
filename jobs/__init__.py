"""Runnable jobs. Each module has a function that takes a session, and a command line that makes one."""
