"""quarrysift: search and analysis of source trees and text corpora on Spark."""

__version__ = "0.1.0"
