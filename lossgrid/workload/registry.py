"""All registered queries."""

from lossgrid.workload import claims, learning, models, portfolio, predictions, sources, steps

PARTS = [claims, portfolio, predictions, learning, models, sources]
STEPS = {**steps.STEPS, **portfolio.STEPS, **predictions.STEPS, **learning.STEPS, **sources.STEPS}
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
