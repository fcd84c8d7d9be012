from shelfwise.functions.exprs import (days_late, fine_amount, full_name,
                                       late_days, pct, pct_exact,
                                       position_in, ratio, round_ratio)

__all__ = ["days_late", "fine_amount", "full_name", "late_days", "pct", "pct_exact", "round_ratio",
           "position_in", "ratio"]
