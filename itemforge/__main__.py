import sys

from itemforge.plans.pipeline import main

sys.exit(main())
