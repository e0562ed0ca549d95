"""Folders of the driver's tables that the tests read."""

import os

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("BF_TEST_SF", "/root/testdata/sf0.01")
