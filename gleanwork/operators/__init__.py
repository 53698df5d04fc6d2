"""DataFrame operators: filtering, deduplication, sampling, quotas, attempts, evaluation, review, gates."""
