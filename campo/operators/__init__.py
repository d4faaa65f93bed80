"""DataFrame operators: cleaning, targets, statistics, features, learning, advice."""
