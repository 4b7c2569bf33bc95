"""``python -m tracemill``."""

import sys

from tracemill.cli import main

sys.exit(main())
