"""Folders of the given tables (a module of its own name: each tests folder has a ``conftest``)."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
