"""Tidewell: a PySpark-native engine for catalogues of large recordings and the data derived from them."""

__version__ = "0.1.0"
