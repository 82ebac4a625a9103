import sys

from fieldloom.plans.api import main

sys.exit(main())
