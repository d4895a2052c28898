"""``python -m shardfold ...`` runs a merge job; see :mod:`shardfold.plans.run`."""

import json

from .plans.run import main

print(json.dumps(main()))
