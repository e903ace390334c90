"""Fixture tooling (BigWig writer) for tests, benchmark and round-trip queries."""
