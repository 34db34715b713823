"""DataFrame operators: cleaning, search, features, models, metrics, charts."""
