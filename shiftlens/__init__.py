"""Workforce analytics on Spark: employee and timesheet files to KPIs."""
