"""Where the smallest tables lie."""

SMALL = "/root/testdata/sf0.001"
