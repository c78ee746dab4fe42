"""Relational operators on journeys, stop events and delay reports."""
