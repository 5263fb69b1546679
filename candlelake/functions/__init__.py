from candlelake.functions.expressions import (
    diversification_label,
    divide_or,
    hashed_uniform,
    ohlc_rules,
)
from candlelake.functions.lookback import over_lookback, with_lookback
from candlelake.functions.prefix import running_product

__all__ = [
    "diversification_label",
    "divide_or",
    "hashed_uniform",
    "ohlc_rules",
    "over_lookback",
    "running_product",
    "with_lookback",
]
