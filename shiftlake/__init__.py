"""shiftlake: workforce analytics (employees, timesheets) as Spark DataFrame jobs.

Layers:
  sources/    raw delimited files, bronze landing, lake paths, driver-table fixtures
  functions/  column expressions (parsing, stripping, rounding, interval arithmetic)
  operators/  keep-first de-duplication, silver cleaning, headcount sweep,
              rolling average, batch row changes
  plans/      gold KPIs, SQL-file KPI variants, serving reads, chart datasets,
              data quality, the end-to-end job
  llm/        operations of a training-data pipeline (optional; nothing else imports it)
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
