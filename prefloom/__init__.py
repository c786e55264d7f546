"""Preference-data engine: pairs, rewards, rollouts and training logs as Spark jobs."""
