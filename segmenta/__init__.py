"""segmenta — survey-style segmentation and description on Spark DataFrames.

Every operator takes and returns a DataFrame and is parameterised by column
lists.  See README.md for the operator map.
"""

__version__ = "0.1.0"
