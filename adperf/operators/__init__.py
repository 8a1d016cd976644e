"""DataFrame operators: cleaning, features, roll-up, quality, reports, budget."""
