"""Where the tests read their tables; a name of its own, so that several conftest modules do not hide it."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
