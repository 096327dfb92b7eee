"""flowlens: network-flow detection and alert analytics on Spark."""

__version__ = "0.1.0"
