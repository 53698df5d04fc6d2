"""Multi-operator plans: collection, classification, evaluation and publication."""
