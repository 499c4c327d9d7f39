"""Registered queries, grouped by the kind of operator they run."""

import importlib

GROUPS = ("evaluation", "projections", "labels", "timeline", "datasets", "motion", "documents", "streams")


def load():
    for g in GROUPS:
        importlib.import_module(f"framelark.plans.{g}")
    return importlib.import_module("framelark.plans.registry")
