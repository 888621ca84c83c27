"""ledgerlens: transaction-risk analytics as plain Spark DataFrame jobs.

Every public operator takes DataFrame(s) plus parameters and returns a
DataFrame; the SparkSession is passed in by the caller, never created here
(except by :mod:`ledgerlens.session` for tests and the bench).
"""

__version__ = "0.1.0"
