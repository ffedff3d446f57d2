"""sparkrec: recommendation analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns a lazy DataFrame. Operators that
the original system ran once per user are written here for a whole user
DataFrame at once (all users by default); a single user is a filter.
"""

__version__ = "0.1.0"
