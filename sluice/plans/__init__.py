"""Whole loads: target tables, the audit log, and the job that ties them together."""
