"""Whole relay plans: the batch relay and the registered query catalog."""

from ferry.plans.relay import RelayOutput, relay

__all__ = ["RelayOutput", "relay"]
