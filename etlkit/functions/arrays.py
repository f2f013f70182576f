from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_of(*choices: tuple[Column, Column]) -> Column:
    """Array of the values whose condition holds, in the order given; an unknown condition does not hold.

    Concatenation compiles to code with the expressions inside it, which filtering an array of NULLs does not.
    """
    return F.concat(*[F.when(condition, F.array(value)).otherwise(F.array()) for condition, value in choices])
