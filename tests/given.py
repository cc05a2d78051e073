"""Where the given tables lie."""

from __future__ import annotations

import os
from pathlib import Path

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))
