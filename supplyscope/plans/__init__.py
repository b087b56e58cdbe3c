"""Plans: the registered query catalog (Spark side and DuckDB oracle SQL)
and the end-to-end pipeline."""


def load_all():
    """Import every catalog module (registration happens at import)."""
    from supplyscope.plans import catalog  # noqa: F401
    from supplyscope.plans import registry
    for mod in ("catalog_models", "catalog_alerts", "catalog_reports", "catalog_sinks"):
        try:
            __import__(f"supplyscope.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"supplyscope.plans.{mod}":
                raise
    return registry
