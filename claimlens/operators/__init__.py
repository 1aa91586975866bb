"""DataFrame operators: ranks, quantiles, merges, profiles, drift, models, governance."""
