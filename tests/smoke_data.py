"""Folder of the smallest driver tables, shared by the tests of this folder."""

SMOKE = "/root/testdata/sf0.001"
