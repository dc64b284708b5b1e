"""spark-submit launcher: ``spark-submit --py-files tessera.zip run_tessera.py --raw-path ... --output-path ...``."""

import sys

from tessera.plans.cli import main

if __name__ == "__main__":
    sys.exit(main())
