import sys

from casebook.plans.job import main

sys.exit(main())
