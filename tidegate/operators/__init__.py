from tidegate.operators.lateness import flag_late
from tidegate.operators.sketches import roll_up, sketch_windows, with_estimate
from tidegate.operators.slowest import flag_late_by_slowest
from tidegate.operators.validation import validate
from tidegate.operators.windows import tumbling_aggregate

__all__ = [
    "flag_late",
    "flag_late_by_slowest",
    "roll_up",
    "sketch_windows",
    "tumbling_aggregate",
    "validate",
    "with_estimate",
]
