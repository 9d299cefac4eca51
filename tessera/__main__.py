"""`python -m tessera <command> …` — same as `python -m tessera.cli`."""

import sys

from tessera.cli import main

sys.exit(main())
