"""Sluice: spec-driven ingestion and data-quality jobs on Spark DataFrames."""

from sluice.spec import JobSpec, Rule, SourceSpec, SpecError, TargetSpec, load_spec, parse_spec

__all__ = ["JobSpec", "Rule", "SourceSpec", "SpecError", "TargetSpec", "load_spec", "parse_spec"]
