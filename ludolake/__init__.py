"""ludolake: product analytics for mobile-game events on Spark.

Raw nested events → flat per-event tables → small daily metric tables, each
buildable in full or extended with only the new days.
"""

__version__ = "0.1.0"
