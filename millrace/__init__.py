"""millrace: text-corpus preparation and batch scoring as Spark jobs.

Every public function takes DataFrames (or a session and a path) and returns a
DataFrame; nothing here keeps rows on the driver.
"""

__version__ = "0.1.0"
