"""``python -m gridlake``: see ``gridlake.cli``."""

import sys
from pathlib import Path

if __package__ in (None, ""):  # run as a file (spark-submit gridlake/__main__.py)
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridlake.cli import main  # noqa: E402

sys.exit(main())
