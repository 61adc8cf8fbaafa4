"""Folders of the given tables, for the tests of the main part."""
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
