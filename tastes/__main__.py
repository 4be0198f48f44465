"""`spark-submit tastes/__main__.py --ratings-dir ... --titles-file ... --output-dir ...`

Also `python -m tastes ...` when a master is configured. Only the driver
imports this package: the plan uses no Python functions on executors.
"""

import sys
from pathlib import Path

if __package__ in (None, ""):
    # Run as a script (spark-submit): make the package importable.
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tastes.job import main  # noqa: E402

if __name__ == "__main__":
    main()
