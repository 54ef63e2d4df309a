"""Composed plans: silver/gold layer stack, reports, questions, query registry, oracle SQL."""
