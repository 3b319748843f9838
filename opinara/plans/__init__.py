"""Workflows that fit a model between two DataFrame stages."""
