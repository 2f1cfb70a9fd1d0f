"""sparkwright: tabular and text preparation plus supervised learning, as Spark jobs.

Every operator takes a DataFrame and returns a DataFrame.  Fitting operators
return ``(model, table)`` where ``table`` is a small DataFrame describing what
was learned.  The heavy work (scans, aggregates, model fitting) runs on Spark;
nothing row-proportional passes through the driver.
"""

__version__ = "0.1.0"
