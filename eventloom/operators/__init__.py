"""DataFrame-to-DataFrame operators: cleaning, statistics, quality, features, learning, search."""
