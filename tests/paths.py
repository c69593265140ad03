"""Folders of the given tables."""

TESTDATA_SMALL = "/root/testdata/sf0.001"
