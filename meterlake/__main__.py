import sys

from meterlake.cli import main

sys.exit(main())
