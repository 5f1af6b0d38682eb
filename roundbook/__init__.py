"""roundbook — company and funding-round enrichment on Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters) and returns a
DataFrame; nothing is collected to the driver except bounded axes (quarter
labels, partition summaries) whose size limit is stated where they are built.
"""

__version__ = "0.1.0"
