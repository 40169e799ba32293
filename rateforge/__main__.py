"""``python -m rateforge ...`` runs the batch job (see ``plans.job``)."""

from .plans.job import main

main()
