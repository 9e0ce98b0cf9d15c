from .tables import table  # noqa: F401
