"""Shared plan shapes: size checks, per-key caps, skew-safe ranks and range joins."""
