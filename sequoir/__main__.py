import sys

from sequoir.cli import main

sys.exit(main())
