from .weekly_kpi import run_weekly_kpi, run_weekly_kpi_final, weekly_kpi_stream  # noqa: F401
