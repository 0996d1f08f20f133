"""Trip analytics as Spark DataFrame operators and reports."""

from farebox.params import ReportWindow

__all__ = ["ReportWindow"]
