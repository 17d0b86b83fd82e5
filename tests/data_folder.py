"""Where the driver's smallest tables are."""

DATA = "/root/testdata/sf0.001"
