"""offhours: events that never stop, set against a market that closes.

Reusable PySpark DataFrame operators that clean and score a round-the-clock
event feed, line it up with an intermittently open market series, roll what
happens while the market is closed forward to the next open candle, and shape,
profile and calibrate the result.
"""

__version__ = "0.1.0"
