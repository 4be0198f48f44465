"""Sinks: the CSV report."""

from tastes.sinks.report import format_report, write_report

__all__ = ["format_report", "write_report"]
