"""Composed jobs: the registered queries (catalog) and the end-to-end runs
(forecasting, explanatory, final evaluation, ensemble validation)."""
