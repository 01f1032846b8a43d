"""Log and trip analytics as PySpark DataFrame functions.

Every function takes DataFrames (and plain parameters) and returns a
DataFrame.  The session belongs to the caller: nothing here builds, tunes or
stops one, and nothing collects rows to the driver.
"""
