from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character up to and including the blank counts as padding.
PADDING = "".join(map(chr, range(0x21)))


def trim_controls(text: Column) -> Column:
    """Strip blanks, tabs and other control characters from both ends.

    Spark's one-argument ``trim`` strips the blank only.
    """
    return F.btrim(text, F.lit(PADDING))
