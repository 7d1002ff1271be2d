"""Inputs that several tests of this folder share."""

SMALL = "/root/testdata/sf0.001"
LABELLED = "/root/testdata/sf0.01"
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (None, "a row without an id but with some words"), (4, "one"), (4, "one"), (5, "word " * 30_000), (6, "naïve café 😀 " * 3)]
