"""millrace - a PySpark-native engine for turning web pages and text into training data."""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Let Python workers get our functions by value, so that no executor needs this package installed."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
