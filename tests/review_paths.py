"""Folders of the given tables (a module of its own: every test folder has a ``conftest``)."""

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
