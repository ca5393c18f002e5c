"""Reusable multi-step operators built from DataFrame primitives."""
