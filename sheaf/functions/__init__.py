"""Column expressions. Every helper gives the ANSI-off answer with ANSI mode on or off."""

from sheaf.functions.safe import (as_col, item, round_half_up, safe_div,
                                  split_item, try_cast)
from sheaf.functions.dates import date_parts, days_between, text_to_date
from sheaf.functions.arith import flag_count, null_count, ratio, row_sum

__all__ = ["as_col", "item", "round_half_up", "safe_div", "split_item", "try_cast",
           "date_parts", "days_between", "text_to_date", "flag_count", "null_count", "ratio",
           "row_sum"]
